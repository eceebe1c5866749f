"""Decontamination, toxicity and the pipeline."""

import pathlib
import random
import time
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from llm_samples import EDGE, words
from tidemark.llm import decontamination, quality_rules, toxicity


def embedded(item, seed, swap=0):
    w = list(item)
    for k in range(swap):
        w[3 + 6 * k] = f"swap{k}"
    return " ".join(words(seed, 40) + w + words(seed + 1, 40))


def test_passages_with_substitutions_are_found(spark, documents, clashing):
    items = {k: words(100 + k, 25 + k) for k in range(6)}
    items[6] = ["too", "short", "an", "item"]
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()] + [(None, None), (8, "")], "item_id bigint, text string")
    rows = [(10 + k, embedded(items[k], 200 + 2 * k)) for k in range(6)]
    rows += [(20 + k, embedded(items[k], 300 + 2 * k, swap=4)) for k in range(6)]
    rows += [(30 + k, " ".join(words(400 + k, 200))) for k in range(20)]
    rows += [(60, " ".join(items[0][:6] + words(5, 50))), (61, " ".join(items[1]).upper().replace(" ", ", ")), (62, None), (63, "too short an item")]
    rows += [(64, " ".join(items[5][4:])), (10, rows[0][1])] + [(70 + k, t) for k, t in enumerate(EDGE)]
    frame = clashing(documents(rows))
    found = decontamination.contaminated_pairs(frame, benchmark).collect()
    want = {(10 + k, k) for k in range(6)} | {(20 + k, k) for k in range(6)} | {(61, 1), (63, 6), (64, 5)}
    assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want)
    exact = next(r for r in found if r.doc_id == 10)
    assert (exact.similarity, exact.start, exact.matched_words) == (1.0, 40, 25)
    kept = decontamination.uncontaminated(frame, benchmark)
    assert kept.columns == frame.columns
    assert kept.count() == len(rows) - len(want) - 1
    assert decontamination.contaminated_pairs(documents([]), benchmark).count() == 0
    assert decontamination.contaminated_pairs(frame, benchmark.limit(0)).count() == 0


def fewest_changes(length, masks):
    """Fewest changed words of an item of so many words that leave no seed of (mask, span)."""
    best = {0: 0}
    for at in range(length):
        after = {}
        for state, changes in best.items():
            for changed in (0, 1):
                now = (state << 1 | changed) & 255
                if all(at + 1 < span or any(now >> (span - 1 - place) & 1 for place in mask) for mask, span in masks):
                    after[now] = min(after.get(now, length), changes + changed)
        best = after
    return min(best.values(), default=length + 1)


def test_every_allowed_agreement_leaves_a_seed():
    d = decontamination
    for length in range(d.SPAN, 120):
        masks = [(m, d.SPAN) for m in d.MASKS] + [(m, d.SHORT_SPAN) for m in d.SHORT_MASKS if length in d.SHORT_LENGTHS]
        assert fewest_changes(length, masks) > length // 5, length


def test_short_items_with_substitutions_are_found(spark, documents):
    changed = {8: [(0,), (7,)], 10: [(1, 2)], 11: [(3, 7)], 15: [(3, 7, 11)], 12: [(0, 11)]}
    items = {n: words(900 + n, n) for n in changed}
    rows = []
    for n, places in changed.items():
        for at in places:
            w = [f"other{k}" if k in at else word for k, word in enumerate(items[n])]
            rows += [(len(rows) * 100 + n, " ".join(words(n, 30) + w + words(n + 1, 30))), (len(rows) * 100 + 100 + n, " ".join(w))]
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()] * 2, "item_id bigint, text string")
    found = decontamination.contaminated_pairs(documents(rows + [(99_999, " ".join(items[8][:6]))]), benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == sorted((i, i % 100) for i, _ in rows)


def test_items_below_the_span_of_a_mask_count_where_all_their_words_agree(spark, documents):
    """Every length from one word on, next to longer items; the pairs are those of the SQL, which knows no seeds."""
    import duckdb

    from tidemark.llm.queries import DECONTAMINATION_SQL

    items = {n: words(700 + n, n, 10_000) for n in (1, 2, 3, 5, 7, 8, 11, 30)}
    rows = [(n, embedded(w, 800 + n)) for n, w in items.items()]
    rows += [(100 + n, " ".join(w)) for n, w in items.items()]
    rows += [(200 + n, " ".join([*w[:-1], "other"])) for n, w in items.items() if n > 1]
    rows += [(300 + n, " ".join(w[:-1])) for n, w in items.items() if n < 8] + [(400, f"{items[1][0]}, " * 50), (401, None), (402, " .")]
    table = [(n, " ".join(w)) for n, w in items.items()] + [(50, None), (51, "?!")]
    found = decontamination.contaminated_pairs(documents(rows), spark.createDataFrame(table, "item_id bigint, text string")).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", table)
    columns = "doc_id, item_id, item_words, matched_words, similarity, start"
    assert sorted(tuple(r[c] for c in columns.split(", ")) for r in found) == sorted(con.execute(f"SELECT {columns} FROM ({DECONTAMINATION_SQL})").fetchall())
    pairs = {(r.doc_id, r.item_id) for r in found}
    whole = {(k + n, n) for k in (0, 100) for n in items} | {(400, 1)} | {(200 + n, n) for n in (8, 11, 30)}
    assert pairs == whole


def test_seeds_are_broadcast_without_the_words_of_their_item(spark, documents):
    benchmark = spark.createDataFrame([(1, " ".join(words(7, 30)))], "item_id bigint, text string")
    pairs = decontamination.contaminated_pairs(documents([(1, " ".join(words(7, 30)))]), benchmark)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2 and pairs.count() == 1


def test_blocks_of_items_give_the_same_pairs(spark, documents, monkeypatch):
    items = {k: words(100 + k, 30) for k in range(5)}
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id bigint, text string")
    docs = documents([(k, embedded(items[k], 50 + k)) for k in range(5)])
    monkeypatch.setattr(decontamination, "SEED_WORDS", 40)
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated_pairs(docs, benchmark).collect()} == {(k, k) for k in range(5)}


def brute_pooled(model, hashes):
    x = model.embedded(hashes)
    x = np.concatenate([x, np.zeros((2, x.shape[1]), np.float32)])
    out = []
    for k, width in enumerate(toxicity._WIDTHS):
        values = np.array([model.biases[k] + sum(x[i + d] @ model.filters[k][d] for d in range(width)) for i in range(len(hashes))])
        values = np.concatenate([np.zeros((toxicity._TOP, toxicity._FILTERS)), values])
        out.append(-np.sort(-values, axis=0)[: toxicity._TOP])
    return np.array(out)


def test_pooling_over_segments_matches_brute_force(monkeypatch):
    model = toxicity.train([], np.array([], int), np.array([], bool))
    hashes = toxicity.word_hashes(" ".join(words(1, 300)))
    for segment in (7, 64, 1000):
        monkeypatch.setattr(toxicity, "_SEGMENT", segment)
        assert np.allclose(model.pooled(hashes)[0], brute_pooled(model, hashes), atol=1e-5)


def test_toxic_documents_are_told_apart_in_the_held_out_fold(spark, documents, clashing):
    draw = random.Random(3)
    insults, rows, labels = ["grobnak", "vileth", "scumwort"], [], []
    for k in range(400):
        w, toxic = words(k, 60), int(k % 3 == 0)
        for _ in range(3 * toxic):
            w[draw.randrange(60)] = draw.choice(insults)
        rows.append((k, " ".join(w)))
        labels.append((k, 1, toxic))
    docs = documents(rows + [(1000, None), (None, "vileth"), (1001, "")] + [(2000 + k, t) for k, t in enumerate(EDGE)])
    known = spark.createDataFrame(labels + [(None, 1, 1), (2000, 1, None)], "doc_id bigint, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.scored(clashing(docs), toxicity.fit(docs, known)).collect()}
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found.values())
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(found[k].held_out == (k in held) for k in range(400)) and not found[None].held_out
    right = sum(found[k].predicted == labels[k][2] for k in held) / len(held)
    assert right >= 0.95 and not found[1000].predicted
    assert toxicity.scored(documents([]), toxicity.fit(docs, known.limit(0))).count() == 0


def test_a_score_ignores_all_columns_but_the_text(spark, documents):
    model = toxicity.train([toxicity.word_hashes(" ".join(words(k, 20) + ["vileth"] * (k % 2))) for k in range(60)], np.arange(60) % 2, np.arange(60) % 5 == 1)
    docs = documents([(k, " ".join(words(k, 30))) for k in range(20)])
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("s"), "doc_id": F.col("doc_id") + 1000})
    a = sorted(r.score for r in toxicity.scored(docs, model).collect())
    assert a == sorted(r.score for r in toxicity.scored(other, model).collect())


def test_the_pipeline_keeps_clean_documents(spark, documents, tmp_path):
    clean = [(k, " ".join(words(k, 80))) for k in range(40)]
    item = words(900, 30)
    rows = clean + [(100, clean[3][1]), (101, "too short"), (102, embedded(item, 70)), (103, " ".join(words(80, 60)) + " token=abcdef123456")]
    rows += [(200 + k, " ### ".join(words(300 + k, 60))) for k in range(40)] + [(None, None)]
    root = str(tmp_path)
    documents(rows).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(0, " ".join(item))], "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(k, int(k < 200), 0) for k, _ in rows if k is not None and k < 300], "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    docs, columns = spark.read.parquet(f"{root}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = columns or docs.columns
        stage(spark, docs, root).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        assert docs.columns == columns
    assert {r.doc_id for r in docs.collect()} == {k for k, _ in clean} | {103}
    assert docs.where("doc_id = 103").first().text.endswith(" [SECRET]")
    final = corpus_pipeline.STAGES[-1][1](spark, docs, root).collect()
    assert len(final) == 41 and all(r.round_trip and len(r.ids) == 4 * r.n_tokens for r in final)


def test_one_row_of_a_sampled_id_counts(spark, documents, monkeypatch):
    """A hot id sends one row to the driver, and does not outweigh the others."""
    docs = [(k, f"word{k} " * 40 + "more words of this text") for k in range(60)] + [(7, f"copy number {k} of a hot id") for k in range(500)]
    labels = spark.createDataFrame([(k, k % 2, int(k % 3 == 0)) for k in range(60)], "doc_id bigint, quality int, toxic int")
    seen = {}
    monkeypatch.setattr(quality_rules, "learn_list", lambda x, y: seen.setdefault("quality", len(y)) and [])
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, held: seen.setdefault("toxic", len(texts)))
    quality_rules.fit(documents(docs), labels)
    toxicity.fit(documents(docs), labels)
    assert seen["quality"] == 60
    assert 0 < seen["toxic"] <= 60


def test_every_labelled_row_counts_in_several_shards(spark, documents, clashing, monkeypatch):
    """A word whose rows all lie beyond a bounded sample is learnt; texts of any length take part."""
    monkeypatch.setattr(toxicity, "train", None)
    rows, labels = [], []
    for k in range(900):
        toxic = int(k % 3 == 0)
        insult = ["grobnak", "vileth", "scumwort"][k // 3 % 3]
        rows.append((k, " ".join(words(k, 40 if k % 50 else 8000) + [insult] * (4 * toxic))))
        labels.append((k, 1, toxic))
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = documents(rows)
    model = toxicity.fit(clashing(docs), known, rows=60)
    found = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    held = [k for k in range(900) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum(found[k].predicted == labels[k][2] for k in held) / len(held) >= 0.95
    # What no row of the fit holds keeps its first embedding; a word of any row has moved.
    leaning = [model.tables[0][toxicity._BUCKETS[0](toxicity.word_hashes(w))[0], 0] for w in ("grobnak", "vileth", "scumwort")]
    assert min(leaning) > 0.2
    one_class = known.withColumn("toxic", F.lit(1))
    assert toxicity.fit(docs, one_class, rows=60).weights.any() == False  # noqa: E712


def test_the_fit_keeps_no_copy_of_the_texts(spark, documents):
    """Texts move once; no pass over them is stored besides."""
    folder = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    stored = lambda: {f for f in folder.rglob("*") if f.is_file()}
    rows = [(k, " ".join(words(k, 20) + ["vileth"] * (k % 2))) for k in range(200)]
    before = stored()
    model = toxicity.fit(documents(rows), spark.createDataFrame([(k, 1, k % 2) for k, _ in rows], "doc_id bigint, quality int, toxic int"), rows=30)
    assert model.weights.any() and stored() == before


def test_each_task_trains_as_many_shards_as_the_others(spark, documents, monkeypatch):
    monkeypatch.setattr(toxicity, "_train_shards", lambda dealt: dealt.map(lambda r: r["shard"]).glom().collect())
    rows = [(k, " ".join(words(k, 20))) for k in range(1100)]
    known = spark.createDataFrame([(k, 1, k % 2) for k, _ in rows], "doc_id bigint, quality int, toxic int")
    tasks = toxicity.fit(documents(rows), known, rows=25)
    shards = [set(task) for task in tasks]
    assert len(shards) > 3 and max(map(len, shards)) <= toxicity.SHARDS_A_TASK and max(map(len, shards)) - min(map(len, shards)) <= 1
    # Rows lie by shard, and no shard in two tasks.
    assert all(task == sorted(task) for task in tasks) and sum(map(len, shards)) == len(set.union(*shards))


def zlib_hashes(text):
    return [(zlib.crc32(w), zlib.crc32(w[: toxicity._STEM])) for w in text.lower().encode().translate(toxicity._APART).split()]


def test_words_hashed_side_by_side_have_the_hashes_of_zlib(monkeypatch):
    lengths = (1, 5, 6, 7, 63, 64, 65, 300)
    texts = ["", "  ", "Ärger-é　日本 ", " ".join("x" * n for n in lengths), "y" * 900, *(" ".join(words(k, 50 * k)) + "  \n" for k in range(8))]
    for stretch in (1, 70, 1 << 17):
        monkeypatch.setattr(toxicity, "_STRETCH", stretch)
        found = [list(map(tuple, hashes.tolist())) for hashes in toxicity.hashes_by_text(texts)]
        assert found == [zlib_hashes(text) for text in texts]
        assert [list(map(tuple, toxicity.word_hashes(text).tolist())) for text in texts] == found


def test_hashing_new_words_takes_less_than_hashing_them_one_by_one():
    texts = [" ".join(f"w{k}{n * 7919}" for n in range(400)) for k in range(300)]

    def seconds(run):
        started = time.process_time()
        run()
        return time.process_time() - started

    together = min(seconds(lambda: list(toxicity.hashes_by_text(texts))) for _ in range(3))
    assert together < min(seconds(lambda: [np.array(zlib_hashes(text)) for text in texts]) for _ in range(3))
