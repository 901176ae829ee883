"""Secret scans: fixed patterns, and two character Markov models compared by likelihood ratio.

Three patterns give the base spans. The models add strings that no pattern names: a run of at
least `SHORTEST` key characters that doesn't touch a base span becomes a span of kind `random` if
the bigram model of random strings explains it better than the model of ordinary identifiers, by
`MARGIN` nats. Both models are counted from labelled samples, (text, label) rows: label 1 random,
0 ordinary. `labelled_samples` draws them from the corpus: words, words in capitals or joined, and
rules of one character are ordinary; digests of texts in hexadecimal, base 64 and capitals are random. That draw is
bounded (`SAMPLE` different texts, chosen by a hash over all of them).

All of it is DataFrame code. Positions are code points, ends exclusive.

Defined cases: null and empty texts have no spans; every row is scanned on its own, whole, so
repeated rows, null ids and very long texts need no care; of overlapping spans of different kinds
all are listed, and a redaction covers their union; without any sample the models find nothing
beyond the patterns; extra columns are kept by `redact` and ignored by `scan`; empty tables give
empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from bayline.llm.common import let

SAMPLE = 1000
SHORTEST = 20
MARGIN = 14.0
MASK = "[SECRET]"

# Kind, pattern, group that holds the value, its least length; in listed order.
BASE = (
    ("assign",
     r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
KINDS = [kind for kind, *_ in BASE] + ["random"]
_RUN = r"[A-Za-z0-9+/_-]{%d,}={0,2}" % SHORTEST
# A text without these has no match long enough to count; saves the full search on most texts.
_HINTS = {
    "assign": r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    "access": r"AKIA[A-Z0-9]{12}", "hex": r"[0-9a-f]{32}", "random": r"[A-Za-z0-9+/_-]{%d}" % SHORTEST,
}
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _found(text: Column, kind: int, pattern: str, group: int, least: int, keep=None) -> Column:
    """Spans of the non-overlapping matches whose group is long enough (and passes `keep`)."""
    def listed(between, matches, values):
        def step(acc, i):
            start = acc["at"] + F.length(F.element_at(between, i))
            end = start + F.length(F.element_at(matches, i))
            value = F.element_at(values, i)
            good = F.length(value) >= least
            if keep is not None:
                good = good & keep(value, start, end)
            span = F.array(F.struct(
                start.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end")))
            return F.struct(end.cast("int").alias("at"),
                            F.when(good, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(
            F.sequence(F.lit(1), F.size(matches)),
            F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {_SPANS})").alias("out")),
            step, lambda acc: acc["out"])

    parts = F.struct(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"))
    spans = let(parts, lambda p: F.when(
        F.size(p["matches"]) > 0, listed(p["between"], p["matches"], p["values"])))
    nothing = F.expr(f"cast(array() as {_SPANS})")
    return F.coalesce(F.when(F.rlike(text, F.lit(_HINTS[KINDS[kind]])), spans), nothing)


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns by start, then kind."""
    return F.sort_array(F.concat(*[
        _found(text, k, pattern, group, least) for k, (_, pattern, group, least) in enumerate(BASE)]))


def random_spans(text: Column, base: Column, ratios: Column) -> Column:
    """Spans of runs that the models call random and that touch no base span."""
    def is_random(value, start, end):
        letters = F.transform(F.sequence(F.lit(1), F.length(value) - 1),
                              lambda i: F.ascii(F.substr(value, i, F.lit(1))) * 128
                              + F.ascii(F.substr(value, i + 1, F.lit(1))))
        ratio = F.aggregate(letters, F.lit(0.0), lambda total, pair: total + F.element_at(ratios, pair + 1))
        free = ~F.exists(base, lambda b: (b["start"] < end) & (b["end"] > start))
        return free & (ratio >= MARGIN)

    return _found(text, len(BASE), _RUN, 0, SHORTEST, is_random)


def labelled_samples(docs: DataFrame) -> DataFrame:
    """(text, label) rows drawn from the corpus: 0 ordinary identifiers, 1 random strings."""
    draw = F.shiftrightunsigned(F.xxhash64("text"), 24)
    # The share follows the number of rows, the draw the text: copies go together and count once.
    rows = docs.where(F.col("text").isNotNull()).agg(F.count("*").alias("n"))
    n = rows.first()["n"]
    chosen = (
        docs.select("text", draw.alias("draw"))
        .where(F.col("draw") < min(1.0, SAMPLE / max(n, 1)) * float(1 << 40))
        .groupBy("draw").agg(F.first("text").alias("text"))
    )
    word = F.col("word")
    words = chosen.select(F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9]{2,}"), F.lit(0))).alias("word"))
    words = words.where(~F.rlike(word, F.lit("[A-Za-z].*[0-9]|[0-9].*[A-Za-z]"))).distinct()
    ordinary = words.select(F.explode(F.array(
        word, F.upper(word), F.concat(F.lower(word), F.lit("_"), F.lower(word)),
        F.concat(F.lower(word), F.initcap(word)), F.concat(word, F.lit("-"), word),
        F.concat(F.lit("/"), word, F.lit("/")), F.repeat(F.substr(word, F.lit(1), F.lit(1)), F.lit(3)),
        *[F.lit(c * 4) for c in "-_=/+"])).alias("text"), F.lit(0).alias("label"))
    # Different digests of the same few texts are as random as those of many texts.
    digest = F.sha2(F.concat(F.col("draw").cast("string"), F.col("turn").cast("string")), 512)
    digests = chosen.select("draw", F.explode(F.sequence(F.lit(1), F.lit(16))).alias("turn")).select(
        digest.alias("hex"), F.base64(F.unhex(digest)).alias("mixed"))
    rand = digests.select(F.explode(F.array(
        F.col("hex"), F.translate("mixed", "+/=\r\n", ""),
        F.upper(F.translate("mixed", "+/=\r\n", "")), F.translate("mixed", "\r\n", ""))).alias("text"),
        F.lit(1).alias("label"))
    return ordinary.unionByName(rand)


def fit(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of ASCII characters, from (text, label) samples."""
    pairs = samples.where(F.length("text") >= 2).select("label", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("text") - 1),
        lambda i: F.substr("text", i, F.lit(2)))).alias("pair"))
    # At most two counts for each pair of ASCII characters.
    counts = pairs.where(F.rlike("pair", F.lit(r"^[\x00-\x7f]{2}$"))).groupBy("label", "pair").agg(
        F.count("*").alias("n")).collect()
    seen = {(r["label"], r["pair"]): r["n"] for r in counts}
    if not seen:
        return [0.0] * (128 * 128)
    total: dict[tuple[int, str], int] = {}
    for (label, pair), n in seen.items():
        total[label, pair[0]] = total.get((label, pair[0]), 0) + n

    def log_p(label: int, a: str, b: str) -> float:
        return math.log((seen.get((label, a + b), 0) + 0.5) / (total.get((label, a), 0) + 0.5 * 65))

    return [round(log_p(1, chr(a), chr(b)) - log_p(0, chr(a), chr(b)), 6)
            for a in range(128) for b in range(128)]


def table_column(ratios: list[float]) -> Column:
    """The fitted table as a constant of the plan."""
    return F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")


def _text_spans(docs: DataFrame, ratios: list[float], names: tuple[str, str]) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.withColumn(names[0], base_spans(text))
    return found.withColumn(names[1], random_spans(text, F.col(names[0]), table_column(ratios)))


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of every row."""
    found = _text_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ratios, ("base", "more"))

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[number(k).alias(f"n_{kind}") for k, (kind, *_) in enumerate(BASE)],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.sort_array(F.concat("base", "more"))).alias("spans"),
        F.size("more").cast("long").alias("n_random"))


def free_names(docs: DataFrame, *wanted: str) -> tuple[str, ...]:
    """The names, lengthened until no column of `docs` has them."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return tuple(out)


def redact(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """All rows and columns, with each secret in the text replaced by `MASK`; n_chars follows."""
    *names, before = free_names(docs, "_base", "_more", "_before")
    # Under a name of its own: a lambda would take `text` for the masked column beside it.
    found = _text_spans(docs, ratios, names).withColumn(before, F.col("text"))
    spans = F.sort_array(F.concat(*names))

    def step(acc, s):
        apart = s["start"] >= acc["at"]
        between = F.substr(F.col(before), acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(apart, F.concat(acc["out"], between, F.lit(MASK))).otherwise(acc["out"]).alias("out"))

    masked = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda acc: F.concat(acc["out"], F.substr(F.col(before), acc["at"] + 1)))
    hit = F.size(F.concat(*names)) > 0
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.when(hit, masked).otherwise(F.col(before)).alias("text"))
        elif c == "n_chars":
            columns.append(F.when(hit, F.length(masked)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return found.select(columns)


def learn(docs: DataFrame) -> list[float]:
    return fit(labelled_samples(docs))
