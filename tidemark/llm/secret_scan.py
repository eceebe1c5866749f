"""Secrets in text: fixed patterns, and a randomness test battery for everything else.

A candidate is a long run of token characters with letters and digits; `=` ends one unless
it is padding, so of NAME=value the value is tested alone.  Of a run that base patterns
cover in part, what they leave is tested.  A candidate's encoding is inferred from its characters, and three tests ask how well it fits uniform draws from
that alphabet:

* chi-squared: symbol counts against uniformity over the alphabet,
* runs: changes between digits, capitals and small letters,
* serial correlation of neighbouring symbols.

Each test takes a structured token as its null hypothesis (draws from half the alphabet,
half the changes, a correlation of 0.5), so a small p-value speaks for randomness.  The
three are combined by Stouffer's sum.  Within a document the candidates are a family
under weighted Benjamini-Hochberg control: a candidate's weight is its length over the
mean length, since a longer token carries more evidence.

Everything is built-in functions over arrays of one row; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, running_sum

#: Kinds in the order of the contract; the last is the method's own.
KINDS = ("assign", "access", "hex", "random")
#: The patterns of the base kinds, in Java's syntax.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: The parts of a run of CANDIDATE between its equals signs, with the padding at its end.
PARTS = r"[A-Za-z0-9+/_-]{20,}(?:=+(?![A-Za-z0-9+/_=-]))?"
LEAST_SYMBOLS = 20
#: Rate of false discoveries among the reported random tokens of a document.
FALSE_DISCOVERY = 0.001
MARK = "[SECRET]"

#: (pattern of the whole token, its alphabet), first match counts.
ENCODINGS = (
    ("^[0-9a-f]+$", "0123456789abcdef"),
    ("^[0-9A-F]+$", "0123456789ABCDEF"),
    ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("^[0-9A-Z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("^[0-9A-Za-z+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
_NO_PIECES = "array<struct<hit:string,start:bigint,end:bigint>>"
_NO_SPANS = "array<struct<start:bigint,end:bigint,kind:int>>"


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal, by the rational approximation of Abramowitz and Stegun 26.2.17."""

    def series(t: Column) -> Column:
        return t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))

    tail = lambda x: F.exp(-x * x / 2) / 2.5066282746310002 * let(1 / (1 + 0.2316419 * x), series)
    return let(z, lambda v: let(tail(F.abs(v)), lambda upper: F.when(v >= 0, upper).otherwise(1 - upper)))


def _located(df: DataFrame, pattern: str, hits: str, out: str) -> DataFrame:
    """Adds `out`: array of (text, start, end) of the matches of pattern in `text`, by the pieces between them."""
    regex = F.lit(pattern)
    df = df.withColumn(hits, F.regexp_extract_all("text", regex, F.lit(0)))
    df = df.withColumn("pieces", F.when(F.size(hits) > 0, F.transform(F.split("text", pattern, -1), lambda p: F.length(p).cast("bigint"))))
    df = df.withColumn("before", F.when(F.size(hits) > 0, running_sum(F.zip_with(F.slice("pieces", 1, F.size(hits)), hits, lambda p, h: p + F.length(h)))))
    place = lambda h, i: F.struct(
        h.alias("hit"),
        (F.get("before", i) + F.get("pieces", i)).alias("start"),
        (F.get("before", i) + F.get("pieces", i) + F.length(h)).alias("end"),
    )
    return df.withColumn(out, F.when(F.size(hits) > 0, F.transform(hits, place))).drop(hits, "pieces", "before")


def _uncovered(token: Column, base: Column) -> Column:
    """Pieces of a token outside the base spans (by start), without the separators at their ends; the token itself if none meets it."""

    def piece(first: Column, end: Column) -> Column:
        text = F.call_function("substring", token["hit"], (first - token["start"] + 1).cast("int"), F.greatest(end - first, F.lit(0)).cast("int"))

        def trimmed(t: Column) -> Column:
            inner = F.regexp_extract(t, r"^[-+/_=]*(.*?)[-+/_]*$", 1)
            start = first + F.length(F.regexp_extract(t, r"^[-+/_=]*", 0))
            return F.struct(inner.alias("hit"), start.alias("start"), (start + F.length(inner)).alias("end"))

        return F.array(let(text, trimmed))

    def left(spans: Column) -> Column:
        start = F.struct(token["start"].alias("at"), F.array().cast(_NO_PIECES).alias("out"))
        step = lambda a, b: F.struct(F.greatest(a["at"], b["end"]).alias("at"), F.concat(a["out"], piece(a["at"], b["start"])).alias("out"))
        cut = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], piece(a["at"], token["end"])))
        return F.when(F.size(spans) > 0, F.filter(cut, lambda t: F.length(t["hit"]) >= LEAST_SYMBOLS)).otherwise(F.array(token))

    return let(F.filter(base, lambda b: (b["start"] < token["end"]) & (token["start"] < b["end"])), left)


def _candidate(token: Column) -> Column:
    """Struct of start, end, core and alphabet; null alphabet if no encoding fits or letters or digits lack."""

    def encoded(core: Column) -> Column:
        mixed = core.rlike("[0-9]") & core.rlike("[A-Za-z]")
        alphabet = F
        for pattern, symbols in ENCODINGS:
            alphabet = alphabet.when(mixed & core.rlike(pattern), F.lit(symbols))
        return F.struct(token["start"].alias("start"), token["end"].alias("end"), core.alias("core"), alphabet.alias("alphabet"))

    return let(F.regexp_replace(token["hit"], "[-_=]", ""), encoded)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))


def _p_value(c: Column) -> Column:
    """Struct of start, end, n and the combined p-value of a candidate."""
    chars = F.filter(F.split(c["core"], "", -1), lambda x: x != "")
    symbols = F.struct(
        F.length(c["core"]).cast("double").alias("n"),
        F.length(c["alphabet"]).cast("double").alias("size"),
        F.transform(chars, lambda x: F.call_function("locate", x, c["alphabet"]).cast("double")).alias("index"),
        F.transform(chars, lambda x: F.when(x.rlike("[0-9]"), 0).when(x.rlike("[A-Z]"), 1).when(x.rlike("[a-z]"), 2).otherwise(3)).alias("kind"),
    )

    def counted(s: Column) -> Column:
        squares = F.transform(F.array_distinct(s["index"]), lambda i: F.pow(F.size(F.filter(s["index"], lambda x: x == i)).cast("double"), F.lit(2.0)))
        change = F.transform(s["kind"], lambda k, i: F.when(F.get(s["kind"], i + 1) != k, 1.0).otherwise(0.0))
        return F.struct(
            s["n"].alias("n"), s["size"].alias("size"),
            (_total(squares) - s["n"]).alias("equal"),
            _total(change).alias("changes"),
            let(_total(s["index"]) / s["n"], lambda mean: F.transform(s["index"], lambda x: x - mean)).alias("index"),
        )

    def correlated(s: Column) -> Column:
        spread = _total(F.transform(s["index"], lambda x: x * x))
        lagged = _total(F.transform(s["index"], lambda x, i: x * F.get(s["index"], i + 1)))
        r = F.greatest(F.lit(-0.999), F.least(F.lit(0.999), F.coalesce(F.try_divide(lagged, spread), F.lit(0.999))))
        return F.struct(*[s[f].alias(f) for f in ("n", "size", "equal", "changes")], r.alias("r"))

    def combined(s: Column) -> Column:
        n, size = s["n"], s["size"]
        pairs = n * (n - 1)
        # Chi-squared: size / n * (equal + n) - n, affine in the number of ordered equal pairs.
        uniform = (pairs * 2 / size - s["equal"]) / F.sqrt(2 * pairs * (2 / size) * (1 - 2 / size))
        # Half the changes of class that uniform draws from the alphabet show.
        rate = F.when(size == 16, 0.234).when(size == 32, 0.152).when(size == 36, 0.2).otherwise(0.32)
        runs = let(rate, lambda q: (s["changes"] - (n - 1) * q) / F.sqrt((n - 1) * q * (1 - q)))
        serial = (0.5493061443340549 - F.abs(F.atanh(s["r"]))) * F.sqrt(n - 3)
        return F.struct(_upper_tail((uniform + runs + serial) / 1.7320508075688772).alias("p"), n.alias("n"), c["start"].alias("start"), c["end"].alias("end"))

    return let(let(let(symbols, counted), correlated), combined)


def _discoveries(tested: Column) -> Column:
    """Spans of the candidates that pass weighted Benjamini-Hochberg control among those of the document."""
    mean = F.aggregate(tested, F.lit(0.0), lambda a, c: a + c["n"]) / F.size(tested)
    weighted = let(mean, lambda m: F.sort_array(F.transform(tested, lambda c: F.struct((c["p"] * m / c["n"]).alias("v"), c["start"].alias("start"), c["end"].alias("end")))))

    def below(ranked: Column) -> Column:
        last = let(
            FALSE_DISCOVERY / F.size(ranked),
            lambda line: F.array_max(F.transform(ranked, lambda c, i: F.when(c["v"] <= (i + 1) * line, i + 1).otherwise(0))),
        )
        return F.transform(F.slice(ranked, 1, last), lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), F.lit(3).alias("kind")))

    return let(weighted, below)


def scanned(rows: DataFrame) -> DataFrame:
    """Adds `base` and `random` to rows (with `text`, not null): arrays of (start, end, kind number).

    `random` are the method's spans; none overlaps a base span.
    """
    df = _located(rows, ASSIGN, "hits", "assign")
    df = _located(df, ACCESS, "hits", "access")
    df = _located(df, HEX, "hits", "hexes")
    df = _located(df, PARTS, "hits", "candidates")
    span = lambda number: lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(number).alias("kind"))
    none = F.array().cast(_NO_SPANS)
    long_enough = F.filter("assign", lambda m: F.length(F.regexp_extract(m["hit"], ASSIGN, 2)) >= 6)
    base = F.concat(
        F.coalesce(F.transform(long_enough, span(0)), none),
        F.coalesce(F.transform("access", span(1)), none),
        F.coalesce(F.transform("hexes", span(2)), none),
    )
    order = lambda spans: F.transform(
        F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    df = df.withColumn("base", order(base)).drop("assign", "access", "hexes")
    free = lambda both: F.flatten(F.transform(both["candidates"], lambda m: _uncovered(m, both["base"])))
    fitting = F.filter(F.transform(let(F.struct("candidates", "base"), free), _candidate), lambda c: c["alphabet"].isNotNull() & (F.length(c["core"]) >= LEAST_SYMBOLS))
    df = df.withColumn("tested", fitting).drop("candidates")
    random = F.when(F.size("tested") > 0, let(F.transform("tested", _p_value), lambda t: F.sort_array(_discoveries(t))))
    return df.withColumn("random", F.coalesce(random, none)).drop("tested")


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def _merged(first: str, second: str) -> Column:
    """All spans by start, then kind."""
    keyed = F.transform(F.concat(first, second), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.sort_array(keyed)


def secrets(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans.

    Spans count code points, the end exclusive.  Null text counts as empty, with no
    spans; repeated rows and null ids each keep a row; other columns are ignored; an
    empty table gives an empty result.
    """
    found = scanned(docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"))).withColumn("every", _merged("base", "random"))
    count = lambda k: F.size(F.filter("every", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.col("every")).alias("spans"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every span of `text` replaced by a mark; no row goes, and null text stays null."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = scanned(docs.select(whole, F.coalesce(docs["text"], F.lit("")).alias("text"))).withColumn("every", _merged("base", "random"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        gap = F.call_function("substring", F.col("text"), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        longer = F.when(s["start"] >= a["at"], F.concat(a["out"], F.array(gap, F.lit(MARK)))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), longer.alias("out"))

    finish = lambda a: F.concat(F.array_join(a["out"], ""), F.call_function("substring", F.col("text"), (a["at"] + 1).cast("int"), F.length("text")))
    clean = F.when(F.size("every") > 0, F.aggregate("every", start, step, finish)).otherwise(F.col("row.text"))
    return found.select("row", clean.alias("clean")).select(
        *[(F.col("clean") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    )
