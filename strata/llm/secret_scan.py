"""Secret scan (operator 13): fixed patterns plus sliding-window entropy, in Spark SQL functions only.

Each text is one row of one projection: no shuffle, no join, no Python worker.

Places. ``regexp_extract_all`` gives the matches of a pattern and ``split`` the
gaps between them, both leftmost and non-overlapping; a running total of their
lengths (code points) gives every start. No mark is put into the text, so a
text may hold any character.

Entropy. A candidate is a maximal stretch of one character class (``CLASSES``)
that is long enough. One fold walks over its characters with the count of each
character in the last ``window`` characters: the entering character raises one
count and the leaving one lowers one, and the sum of ``c * log2(c)`` follows by
two table look-ups. The table holds millionths as integers, so the sum is exact
however long the candidate is. Shannon entropy is ``log2(window) - sum / window``;
windows at or over the class's threshold are joined into spans.

Suppression. A candidate that an allow pattern fits (UUIDs, counters, words of
documentation, paths, ...), or that follows a digest label such as ``sha256:``,
gives no entropy span; nor does an entropy span inside a base span. Base spans
are never suppressed.

Defined results: null and empty texts have no spans; repeated rows and ids are
judged row by row; columns besides id and text are ignored, whatever their name.
A very long text costs time linear in its length (running totals are made in
blocks), and a hot source costs nothing extra, since rows are judged one by one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table

# Kind, pattern, group whose length counts, least length
BASE = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
#: a pattern with the same long matches that skips the short ones at once; valid where short matches hide no long one
LONG_ONLY = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}

#: kind, characters of the class, window, least entropy in bits per character
CLASSES = [
    ("entropy_hex", "0123456789abcdefABCDEF", 24, 3.0),
    ("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", 20, 3.85),
]

#: candidates that these fit are no secrets
ALLOW = [
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)example|placeholder|changeme|dummy|sample|redacted",
    r"(?i)0123456789|abcdefghij|qwertyuiop|(.)\1{7}",
    r"^[0-9_=+/-]+$",
    r"^/?([A-Za-z]{2,}[/_-])+[A-Za-z]*$",
]
#: the text before a candidate that is a published digest; the mark stands for the candidate's start
START_MARK = "\x01"
ALLOW_BEFORE = r"(?i)(sha-?[0-9]{1,3}|md5|digest|checksum|commit|etag)[\"']?[ :=-]{1,3}[\"']?\x01"
BEFORE_CHARS = 16

SPAN = "struct<kind:string,start:bigint,end:bigint>"
BLOCK = 256


def _class_pattern(chars: str, least: int) -> str:
    return "[" + chars.replace("-", r"\-") + "]{" + str(least) + ",}"


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def running_total(values: str) -> str:
    """SQL: inclusive running total of an array of bigint, in blocks, so that no long array is copied per element."""
    scan = "slice(aggregate({a}, array(0L), (t, x) -> concat(t, array(element_at(t, -1) + x))), 2, size({a}))"
    blocks = f"transform(sequence(0, (size({values}) - 1) div {BLOCK}), b -> slice({values}, b * {BLOCK} + 1, {BLOCK}))"
    sums = f"transform({blocks}, x -> aggregate(x, 0L, (s, v) -> s + v))"
    return (f"IF(size({values}) = 0, cast(array() AS array<bigint>), flatten(zip_with({blocks}, {scan.format(a=sums)}, "
            f"(x, upto) -> transform({scan.format(a='x')}, v -> v + upto - aggregate(x, 0L, (s, w) -> s + w)))))")


def _places(df: DataFrame, out: str, pattern: str, group: int = 0) -> DataFrame:
    """``df`` (column ``t``) with ``out``: array of (s: match, g: group, before, start, end) in text order."""
    df = df.withColumn("m", F.regexp_extract_all("t", F.lit(pattern), F.lit(0)))
    df = df.withColumn("g", F.regexp_extract_all("t", F.lit(pattern), F.lit(group)) if group else F.col("m"))
    df = df.withColumn("gaps", F.when(F.size("m") > 0, F.split("t", pattern, -1)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("steps", F.expr(
        "transform(m, (x, i) -> cast(length(gaps[i]) + IF(i = 0, 0, length(m[i - 1])) AS bigint))"))
    df = df.withColumn("starts", F.expr(running_total("steps")))
    return df.withColumn(out, F.expr(
        f"transform(m, (x, i) -> named_struct('s', x, 'g', g[i], "
        f"'before', right(concat(IF(i = 0, '', right(m[i - 1], {BEFORE_CHARS})), right(gaps[i], {BEFORE_CHARS})), {BEFORE_CHARS}), "
        "'start', starts[i], 'end', starts[i] + length(x)))")).drop("m", "g", "gaps", "steps", "starts")


def bits_table(window: int) -> list[int]:
    """Millionths of c * log2(c) for every count of a character in a window."""
    return [0, *(round(c * math.log2(c) * 1e6) for c in range(1, window + 1))]


def most_sum(window: int, least_bits: float) -> int:
    """The largest sum of c * log2(c), in millionths, at which a window's entropy is still ``least_bits``."""
    return math.floor(window * (math.log2(window) - least_bits) * 1e6 + 1e-6)


def _entropy_spans(idx: str, size: int, window: int, least_bits: float) -> str:
    """SQL: joined windows (a, b) of enough entropy over ``idx``, numbers of characters from 1 to ``size``."""
    f = "array(" + ", ".join(f"{v}L" for v in bits_table(window)) + ")"
    new, old = f"{idx}[i]", f"IF(i >= {window}, {idx}[i - {window}], 0)"
    up = f"({f}[z.n[{new}] + 1] - {f}[z.n[{new}]])"
    down = f"IF(i >= {window}, {f}[z.n[{old}] - 1] - {f}[z.n[{old}]], 0L)"
    s = f"(z.s + IF({new} = {old}, 0L, {up} + {down}))"
    first = f"cast(i - {window} + 1 AS bigint)"
    last = "cast(i + 1 AS bigint)"
    joined = (f"IF(size(z.hits) > 0 AND element_at(z.hits, -1).b >= {first}, "
              f"concat(slice(z.hits, 1, size(z.hits) - 1), array(named_struct('a', element_at(z.hits, -1).a, 'b', {last}))), "
              f"concat(z.hits, array(named_struct('a', {first}, 'b', {last}))))")
    # character 0 stands for "none": its count is never used
    return (f"aggregate(sequence(0, size({idx}) - 1), "
            f"named_struct('n', array_repeat(0, {size + 1}), 's', 0L, 'hits', cast(array() AS array<struct<a:bigint,b:bigint>>)), "
            f"(z, i) -> named_struct("
            f"'n', transform(z.n, (c, k) -> c + IF(k = {new}, 1, 0) - IF(k = {old}, 1, 0)), "
            f"'s', {s}, "
            f"'hits', IF(i + 1 >= {window} AND {s} <= {most_sum(window, least_bits)}L, {joined}, z.hits)), "
            f"z -> z.hits)")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes=None, allow=None) -> DataFrame:
    """id, ``base`` and ``spans``: arrays of (kind, start, end), code points, end exclusive, in order of start, then kind.

    ``spans`` holds the base spans and those of the entropy classes.
    """
    classes = CLASSES if classes is None else classes
    allow = ALLOW if allow is None else allow
    df = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    kinds = [k for k, *_ in BASE] + [k for k, *_ in classes]
    order = "array(" + ", ".join(_text(k) for k in kinds) + ")"

    for kind, pattern, group, least in BASE:
        df = _places(df, "p", LONG_ONLY.get(kind, pattern), group)
        df = df.withColumn(f"b_{kind}", F.expr(
            f"transform(filter(p, x -> length(x.g) >= {least}), "
            f"x -> cast(named_struct('kind', {_text(kind)}, 'start', x.start, 'end', x.end) AS {SPAN}))")).drop("p")
    df = df.withColumn("base", F.concat(*[F.col(f"b_{k}") for k, *_ in BASE]))

    for kind, chars, window, bits in classes:
        df = _places(df, "p", _class_pattern(chars, window))
        allowed = " OR ".join([f"x.s RLIKE {_text(a)}" for a in allow] + [f"concat(x.before, char(1)) RLIKE {_text(ALLOW_BEFORE)}"])
        df = df.withColumn("p", F.expr(f"filter(p, x -> NOT ({allowed}))"))
        df = df.withColumn("p", F.expr(
            "transform(p, x -> named_struct('start', x.start, 'idx', "
            f"transform(split(x.s, ''), c -> instr({_text(chars)}, c))))"))
        df = df.withColumn(f"e_{kind}", F.expr(
            f"flatten(transform(p, x -> transform({_entropy_spans('x.idx', len(chars), window, bits)}, "
            f"h -> cast(named_struct('kind', {_text(kind)}, 'start', x.start + h.a, 'end', x.start + h.b) AS {SPAN}))))")).drop("p")
    found = F.concat(F.col("base"), *[F.col(f"e_{k}") for k, *_ in classes])
    df = df.withColumn("found", found)

    def in_order(spans: str) -> Column:
        return F.expr(f"transform(array_sort(transform({spans}, x -> named_struct("
                      f"'start', x.start, 'k', array_position({order}, x.kind), 'end', x.end, 'kind', x.kind))), "
                      f"x -> cast(named_struct('kind', x.kind, 'start', x.start, 'end', x.end) AS {SPAN}))")

    fixed = "array(" + ", ".join(_text(k) for k, *_ in BASE) + ")"
    free = (f"filter(found, x -> array_contains({fixed}, x.kind) OR "
            "NOT exists(base, y -> y.start <= x.start AND x.end <= y.end))")
    return df.select(F.col("id").alias(id_col), in_order("base").alias("base"), in_order(free).alias("spans"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return d.select("doc_id", *[count(k).alias(f"n_{k}") for k, *_ in BASE],
                    F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def _oracle() -> str:
    """DuckDB SQL: matches by splitting, every window's characters counted from scratch, windows joined as islands."""
    quote = lambda v: "'" + v.replace("'", "''") + "'"
    # DuckDB's engine folds letters beyond ASCII and knows no back-references: both are spelled out
    folded = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    assign = BASE[0][1].replace("(?i)(password|passwd|secret|token|api_?key)", f"({folded})")
    patterns = [(k, assign if k == "assign" else p, g, n) for k, p, g, n in BASE]
    patterns += [(k, _class_pattern(chars, window), 0, window) for k, chars, window, _ in CLASSES]
    found = " UNION ALL ".join(
        f"SELECT rid, t, {quote(k)} AS kind, {i} AS k, {n} AS least, regexp_extract_all(t, {quote(p)}, 0) AS m, "
        f"regexp_extract_all(t, {quote(p)}, {g}) AS g, string_split_regex(t, {quote(p)}) AS gaps FROM d"
        for i, (k, p, g, n) in enumerate(patterns))
    runs = "|".join(("\\" + c if c in "+/=-" else c) + "{8}" for c in "abcdefghijklmnopqrstuvwxyz0123456789+/=_-")
    allowed = " OR ".join(f"regexp_matches(s, {quote(a.replace('|(.)' + chr(92) + '1{7}', ''))})" for a in ALLOW)
    limits = " ".join(f"WHEN {quote(k)} THEN {most_sum(w, b)}" for k, _, w, b in CLASSES)
    base = ", ".join(quote(k) for k, *_ in BASE)
    return f"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
             f AS ({found}),
             e AS (SELECT rid, t, kind, k, least, unnest(m) AS s, unnest(g) AS g, unnest(gaps[1:len(m)]) AS gap, generate_subscripts(m, 1) AS i
                   FROM f WHERE len(m) > 0),
             p AS (SELECT *, CAST(sum(length(gap)) OVER w + coalesce(sum(length(s)) OVER (PARTITION BY rid, kind ORDER BY i
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
                   FROM e WINDOW w AS (PARTITION BY rid, kind ORDER BY i)),
             b AS (SELECT rid, kind, k, start, start + length(s) AS stop FROM p WHERE kind IN ({base}) AND length(g) >= least),
             c AS (SELECT rid, kind, k, i, s, start, least FROM p
                   WHERE kind NOT IN ({base}) AND NOT ({allowed} OR regexp_matches(lower(s), {quote(runs)})
                         OR regexp_matches(right(left(t, CAST(start AS BIGINT)), {BEFORE_CHARS}) || chr(1), {quote(ALLOW_BEFORE)}))),
             w AS (SELECT rid, kind, k, i, start, least, unnest(range(0, length(s) - least + 1)) AS o, s FROM c),
             h AS (SELECT rid, kind, k, i, start, least, o FROM w
                   WHERE list_sum(list_transform(map_values(list_histogram(string_split(substr(s, CAST(o AS BIGINT) + 1, least), ''))),
                                                 lambda n: CAST(round(n * log2(n) * 1e6) AS BIGINT))) <= CASE kind {limits} END),
             j AS (SELECT *, sum(CASE WHEN o > before + least THEN 1 ELSE 0 END) OVER (PARTITION BY rid, kind, i ORDER BY o) AS island
                   FROM (SELECT *, lag(o) OVER (PARTITION BY rid, kind, i ORDER BY o) AS before FROM h)),
             x AS (SELECT rid, kind, any_value(k) AS k, any_value(start) + min(o) AS start, any_value(start) + max(o) + any_value(least) AS stop
                   FROM j GROUP BY rid, kind, i, island),
             a AS (SELECT rid, kind, k, start, stop FROM b UNION ALL
                   SELECT rid, kind, k, start, stop FROM x WHERE NOT EXISTS (
                       SELECT 1 FROM b WHERE b.rid = x.rid AND b.start <= x.start AND x.stop <= b.stop)),
             g AS (SELECT rid, {", ".join(f"count(*) FILTER (kind = {quote(k)}) AS n_{k}" for k, *_ in BASE)},
                          string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (kind IN ({base})) AS base,
                          string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans FROM a GROUP BY rid)
        SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k, *_ in BASE)},
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN g USING (rid)"""


QUERIES = {"op13_secret_scan": op13_secret_scan}
ORACLE = {"op13_secret_scan": _oracle()}
