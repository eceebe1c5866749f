"""HTML extraction and WARC archives."""

import base64
import hashlib

import pytest

from tidemark.llm import html_extract, warc

PROSE = "This sentence, which is part of the article, goes on for a while, and says little. " * 3


def page(body):
    return f"<html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


CASES = {
    page(f"<nav><a href=x>home</a></nav><article><h1>A &amp; B</h1><p>{PROSE}</p><p>two<br>lines &eacute;</p></article><footer>foot</footer>"):
        ["A & B", PROSE.strip(), "two lines é"],
    page(f"<div id=main><h2>Head</h2><p>{PROSE}</p><p>{PROSE}<script>var t='</p>';</script></div><div class=sidebar><p>{PROSE}</p></div><div id=comments><p>{PROSE}</p></div>"):
        ["Head", PROSE.strip(), PROSE.strip()],
    page(f"<article><p><b>Bold {PROSE}<br><p>next</p><form><p>Search, now</p></form></article>"): [("Bold " + PROSE).strip(), "next"],
    f"<article><p>{PROSE}</p><p>cut off &am": [PROSE.strip(), "cut off &am"],
    "": [], "<html></html>": [], "no markup at all": ["no markup at all"],
}


def test_pages(spark, clashing):
    rows = [(k, "u", h) for k, h in enumerate(CASES)] + [(50, None, None), (None, "v", "<p>x</p>"), (0, "u", next(iter(CASES)))]
    frame = clashing(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    found = html_extract.extract(frame).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    for k, blocks in enumerate(CASES.values()):
        assert by_id[k].text == "\n\n".join(blocks) and by_id[k].n_chars == len(by_id[k].text)
    assert by_id[50].text == "" and by_id[None].text == "x"
    assert html_extract.extract(frame.limit(0)).count() == 0


def test_deep_and_unclosed_markup_does_not_recurse():
    assert html_extract.main_text("<div>" * 5000 + "<p>deep, text</p>") == "deep, text"
    assert html_extract.main_text("<p>a" * 300).count("a") == 300


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


MAGIC = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
PAGES = [
    (3, "u", "abc"), (2, None, "abc"), (9, "x\r\ny", "abc"), (4, "x", None), (5, "x", ""), (6, "y", MAGIC + "zz"), (7, "y", MAGIC * 3), (8, "z", "é😀\r\n\r\nx\r\n\r\n"),
    (10, "z", MAGIC + "zz"), (11, "q", "\r\n"), (12, "q", "WARC/1.1\r\n"), (13, "q", "x" * 90_000),
]


def want(pages):
    first = {}
    for i, _, h in pages:
        first[h or ""] = min(first.get(h or "", i), i)
    return sorted(
        (i, len((h or "").encode()), digest(h or ""), "response" if first[h or ""] == i else "revisit", None if first[h or ""] == i else first[h or ""])
        for i, _, h in pages
    )


def read(spark, path):
    return sorted(tuple(r) for r in warc.read_archives(spark, path).collect())


def test_round_trip_with_magic_in_payloads(spark, clashing, tmp_path):
    frame = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    for number, compression in enumerate(("gzip", "none")):
        path = str(tmp_path / f"a{number}")
        warc.write_archives(clashing(frame).repartition(2), path, compression=compression)
        assert read(spark, path) == want(PAGES)
    raw = b"".join(p.read_bytes() for p in (tmp_path / "a1").glob("part-*"))
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n") and b"WARC-Refers-To: <urn:uuid:" in raw


def test_splits_of_a_file(spark, tmp_path):
    pages = [(k, "u", (MAGIC if k % 5 == 0 else "") + "page %d " % (k % 70) * 40) for k in range(120)]
    path = str(tmp_path / "split")
    warc.write_archives(spark.createDataFrame(pages, "page_id bigint, url string, html string").coalesce(1), path, compression="none")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        assert read(spark, path) == want(pages)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_null_ids_repeats_and_empty_tables(spark, tmp_path):
    rows = [(None, "u", "a"), (4, "u", "a"), (4, "u", "a"), (None, None, "b")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = sorted(warc.archived(frame, str(tmp_path / "n")).collect(), key=str)
    assert [(r.page_id, r.record_type, r.refers_to) for r in found] == [
        (4, "response", None), (4, "response", None), (None, "response", None), (None, "revisit", 4),
    ]
    assert warc.archived(frame.limit(0), str(tmp_path / "e")).count() == 0


def test_class_words_on_a_wrapper_do_not_cut_the_article():
    prose = PROSE.strip()
    comments = f"<div id=comments><article class=comment><p>{prose * 5}</p></article></div>"
    for names in ("content with-sidebar", "post tag-alert", "site header-fixed", "article no-share", "page has-comments"):
        for inner in (f"<article><p>{prose}</p></article>", f"<p>{prose}</p>"):
            html = page(f"<p>Logo</p><div class='{names}'>{inner}<div class=sidebar><p>side</p></div>{comments}</div>")
            found = html_extract.main_text(html).split("\n\n")
            assert prose in found and "side" not in found and prose * 5 not in found, (names, inner)
    for names in ("sidebar", "main-menu", "post-tags", "related-posts"):
        assert html_extract.main_text(page(f"<div class=x><p>{prose}</p><p>{prose}</p></div><div class={names}><p>{prose}</p></div>")) == f"{prose}\n\n{prose}"


def test_short_blocks_beside_the_best_container_stay():
    prose, links = PROSE.strip(), "<p><a href=x>more</a></p>"
    text = f"<div class=text>{f'<p>{prose}</p>' * 5}</div>"
    want = "\n\n".join(["Short intro.", *[prose] * 5, "Sub", "item", "Short end."])
    for top, end in (("<div>", "</div>"), ("<article>", "</article>"), ("<article><div>", "</div></article>")):
        assert html_extract.main_text(f"{top}<p>Short intro.</p>{links}{text}<h3>Sub</h3><ul><li>item</ul>{links}<p>Short end.</p>{end}") == want
    nested = f"<article>Loose words<p>Short intro.</p><div><div>{text}</div><div>Note</div></div></article>"
    assert html_extract.main_text(nested) == "\n\n".join(["Loose words", "Short intro.", *[prose] * 5, "Note"])


_BODY = "<p>" + "A sentence of the article, long enough to count, with commas, and so on. " * 4 + "</p>"


@pytest.mark.parametrize("wrapper", ['<form id="aspnetForm" method="post">{}</form>', '<div aria-hidden="true">{}</div>', '<form><div class="content">{}</div></form>'])
def test_a_page_within_a_form_or_a_hidden_wrapper_is_kept(wrapper):
    body = f"<h1>Title</h1><nav><a href='/'>menu</a></nav><article>{_BODY * 3}</article><form><p>Your name, please.</p><input></form>"
    text = html_extract.main_text(f"<html><body>{wrapper.format(body)}</body></html>")
    assert text.count("A sentence of the article") == 12 and "Your name" not in text and "menu" not in text


def test_broken_markup_takes_linear_time():
    import time

    for hostile in (lambda n: "<b>" * n + "</i>" * n, lambda n: "<div>" * n + "</section>" * n, lambda n: "<i><div>" + "<b>" * n + "</i>" * n, lambda n: "<p>" + "<b>x" * n + "<div>" * 3):
        taken = []
        for n in (20_000, 40_000):
            start = time.process_time()
            html_extract.TreeBuilder().feed(hostile(n))
            taken.append(time.process_time() - start)
        assert taken[1] < 3 * taken[0] + 0.1


def test_archives_of_either_version_are_read(spark, tmp_path):
    pages = [(k, f"u{k}", f"<p>{k}</p> WARC/1.{k % 3}\r\n WARC/1.1\r\nContent-Length: 3\r\n\r\nabc") for k in range(9)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    want = None
    for version in "10":
        path = str(tmp_path / version)
        warc.write_archives(frame.coalesce(1), path, compression="none")
        part = next((tmp_path / version).glob("part-*"))
        text = part.read_bytes()
        (tmp_path / version / f".{part.name}.crc").unlink(missing_ok=True)
        part.write_bytes(text.replace(b"WARC/1.1\r\nWARC-Type", f"WARC/1.{version}\r\nWARC-Type".encode()))
        found = sorted(warc.read_archives(spark, path).collect(), key=str)
        assert len(found) == 9
        want = want or found
        assert found == want
