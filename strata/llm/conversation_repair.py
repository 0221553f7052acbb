"""Conversation structure repair (operator 11): Knuth's lightest-derivation agenda.

A conversation's rows, in order of turn, are edited at least cost until the
initials of their roles read ``(s?(ua)+)?``: system at most once and first, then
user and assistant in turn. Keep costs 0, Rerole (to user or assistant) 3,
Delete 4 (a must for blank and duplicate rows), Insert (an empty user or
assistant row) 3, and a truncated row that is not deleted 3 more.

Method. Items are weighted by (cost, audit), compared as a pair; the audit is the
initials of the edits so far. Axioms are the steps: ``row i takes state q to r``
by one edit, and ``an insert takes q to r``. A deduction has two antecedents,

    prefix [i, q] and step [i, q, r]  give  prefix [i + 1, r],

and its weight function adds the costs and joins the audits. It is superior (the
result is never less than an antecedent: costs only grow, audits only get longer)
and monotone: two audits of one item at equal cost use the same rows and equally
many inserts, so neither is a prefix of the other and what is joined to them
cannot turn their order. So the agenda pops items in order of (cost, audit), an
item's first pop is final, and the first final goal item (all rows, in an
accepting state) is the cheapest repair with the ASCII-least audit.

Long conversations. One conversation may hold a third of all rows, so none is
held as a whole. Rows are range-partitioned by (conversation, turn, role, hash of
the text, row number), so even equal rows spread, and each task cuts its sorted
rows. A conversation that lies inside one task and within ``segment_rows`` is
repaired there. Any other is cut into segments; the agenda derives, for each
segment and each start state, the lightest step to every end state; these are
steps again, so ``fan`` of them at a time are joined by the same agenda, in
rounds, until one is left. The states at the joints pick each segment's audit,
and the segments' texts are edited where they lie. Repeated rows of such a
conversation are found by a partial aggregate over text hashes. Only the audit of
a conversation, which is a cell of the result, is ever in one place.

Defined results. Null role and text count as one space (so such a text is blank);
a null conversation id is a conversation; null turns come first; rows of equal
turn are in order of role, then of the text's SHA-256. A conversation without
rows has no summary. Repeated rows are duplicates. Other columns are ignored,
whatever their name. Empty tables give empty results.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import table
from strata.session import stage

SEGMENT_ROWS = 1024
SEGMENT_BYTES = 4 << 20
FAN = 64

# Costs, the states (0 start, 1 after system, 2 after user, 3 after assistant) and what each role does
RETITLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTING = (0, 3)
STATES = (0, 1, 2, 3)
LEGAL_PAIRS = ("su", "ua", "au")
BLANKS = " \t\n\x0b\x0c\r"
ENDINGS = ".!?"

TURN = T.StructType([T.StructField(n, T.StringType()) for n in ("role", "text", "edit")])
COUNTS = ("n_rows", "blank", "duplicate", "truncated", "illegal", "cost")


class Row(NamedTuple):
    """What the repair needs to know of a row."""

    initial: str
    must_go: bool
    cut_off: bool


class Repair(NamedTuple):
    """``summary``: one row per conversation; ``pieces``: conv id, piece, pieces, turns (role, text, edit)."""

    summary: DataFrame
    pieces: DataFrame


def row_steps(row: Row) -> dict[int, list[tuple[int, int, str]]]:
    """Axioms of one row: state -> (state after, cost, edit)."""
    out = {}
    extra = CUT_OFF if row.cut_off else 0
    for q in STATES:
        out[q] = [(q, DELETE, "D")]
        if not row.must_go:
            if (q, row.initial) in STEP:
                out[q].append((STEP[q, row.initial], extra, "K"))
            out[q] += [(STEP[q, role], RETITLE + extra, "R") for role in "ua" if (q, role) in STEP]
    return out


INSERT_STEPS = {q: [(STEP[q, role], INSERT, "I") for role in "ua" if (q, role) in STEP] for q in STATES}


def lightest(steps: list[dict], start: int, inserts: bool, goal: bool) -> dict[int, tuple[int, str, tuple]]:
    """Final weights of the items [n, state]: (cost, audit, states at the joints); only the goal's if ``goal``."""
    n, final, ends = len(steps), set(), {}
    agenda = [(0, "", 0, start, (start,))]
    while agenda:
        cost, audit, i, q, joints = heapq.heappop(agenda)
        if (i, q) in final:
            continue
        final.add((i, q))
        if i == n:
            ends[q] = (cost, audit, joints)
            if goal and q in ACCEPTING:
                return {q: ends[q]}
        else:
            for r, c, edit in steps[i].get(q, ()):
                if (i + 1, r) not in final:
                    # joints of rows are not asked for
                    heapq.heappush(agenda, (cost + c, audit + edit, i + 1, r, joints if inserts else (*joints, r)))
        if inserts:
            for r, c, edit in INSERT_STEPS[q]:
                if (i, r) not in final:
                    heapq.heappush(agenda, (cost + c, audit + edit, i, r, joints))
    return ends


@functools.lru_cache(maxsize=1 << 14)
def cheapest_repair(rows: tuple[Row, ...]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    (cost, audit, _), = lightest([row_steps(r) for r in rows], 0, True, True).values()
    return cost, audit


def segment_steps(rows: Iterable[Row]) -> list[dict]:
    """The steps (q, r, cost, audit, joints) of a segment from every state to every state it can reach."""
    steps = [row_steps(r) for r in rows]
    return [{"q": q, "r": r, "cost": cost, "audit": audit, "joints": [q, r]}
            for q in STATES for r, (cost, audit, _) in sorted(lightest(steps, q, True, False).items())]


def joined_steps(segments: list[list[dict]]) -> list[dict]:
    """The steps of consecutive segments taken as one."""
    edges, inner = [], []
    for seg in segments:
        by_state = {q: [] for q in STATES}
        for s in seg:
            by_state[s["q"]].append((s["r"], s["cost"], s["audit"]))
        edges.append(by_state)
        inner.append({(s["q"], s["r"]): s["joints"] for s in seg})
    out = []
    for q in STATES:
        for r, (cost, audit, joints) in sorted(lightest(edges, q, False, False).items()):
            full = [q]
            for known, a, b in zip(inner, joints, joints[1:], strict=False):
                full += known[a, b][1:]
            out.append({"q": q, "r": r, "cost": cost, "audit": audit, "joints": full})
    return out


def apply_audit(audit: str, rows: list[tuple[str, str]], state: int) -> list[dict]:
    """The repaired rows of a segment that is entered in ``state``."""
    out, at = [], 0
    for edit in audit:
        role, text = rows[at] if edit != "I" else (None, "")
        at += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == 2 else "user"
        state = STEP[state, role[0]]
        out.append({"role": role, "text": text, "edit": edit})
    return out


def inspect(rows: list[tuple[str, str]], repeated: Iterable[int]) -> tuple[list[Row], dict[str, int]]:
    """What the repair needs to know of each row, and the counts of faults; ``repeated``: numbers of duplicate rows."""
    repeated, out = set(repeated), []
    n = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for i, (role, text) in enumerate(rows):
        end = text.rstrip(BLANKS)[-1:]
        fault = "blank" if not end else "duplicate" if i in repeated else "truncated" if end not in ENDINGS else None
        if fault:
            n[fault] += 1
        out.append(Row(role[:1] if role[:1] in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated"))
    n["illegal"] = sum(illegal_pair(a[0], b[0]) for a, b in zip(rows, rows[1:], strict=False))
    return out, n | {"n_rows": len(rows)}


def illegal_pair(role: str, following: str) -> bool:
    return role[:1] + following[:1] not in LEGAL_PAIRS


def _repeats(rows: list[tuple[str, str]]) -> list[int]:
    seen, out = set(), []
    for i, r in enumerate(rows):
        if r in seen:
            out.append(i)
        seen.add(r)
    return out


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _cut(schema: T.StructType, segment_rows: int):
    """Sorted rows (id, role, text) of a range partition -> repaired whole conversations and open segments."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, part = _arrow(schema), TaskContext.get().partitionId()
        here, held, size, seq = None, [], 0, 0
        inside = False      # the conversation began in this partition after another one, and was not cut

        def close(whole):
            nonlocal held, size, seq
            out = {"id": here, "whole": whole, "part": part, "seq": seq}
            if whole:
                rows, counts = inspect(held, _repeats(held))
                cost, audit = cheapest_repair(tuple(rows))
                out |= counts | {"cost": cost, "audit": audit, "turns": apply_audit(audit, held, 0)}
            else:
                out["turns"] = [{"role": r, "text": t, "edit": None} for r, t in held]
            held, size, seq = [], 0, seq + 1
            return out

        for b in batches:
            out = []
            for conv, role, text in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if held and conv != here:
                    out.append(close(inside))
                    inside = True
                elif held and (len(held) >= segment_rows or size >= SEGMENT_BYTES):
                    out.append(close(False))
                    inside = False
                here = conv
                held.append((role, text))
                size += len(text)
            if out:
                yield _batch(out, arrow)
        if held:
            yield _batch([close(False)], arrow)     # it may go on in the next partition

    return work


def _segment(schema: T.StructType):
    """Open segments (id, no, part, seq, turns, dups) -> their steps and counts."""
    def work(batches):
        arrow = _arrow(schema)
        for b in batches:
            out = []
            for r in b.to_pylist():
                turns = [(t["role"], t["text"]) for t in r["turns"]]
                rows, counts = inspect(turns, r["dups"] or ())
                out.append({k: r[k] for k in ("id", "no", "part", "seq")} | counts
                           | {"first": turns[0][0], "last": turns[-1][0], "steps": segment_steps(rows)})
            yield _batch(out, arrow)

    return work


def _join_segments(schema: T.StructType):
    """Rows (id, no, segs: up to ``fan`` consecutive segments) -> one segment each."""
    def work(batches):
        arrow = _arrow(schema)
        for b in batches:
            out = []
            for r in b.to_pylist():
                segs = sorted(r["segs"], key=lambda s: s["no"])
                row = {k: sum(s[k] for s in segs) for k in COUNTS if k != "cost"}
                row["illegal"] += sum(illegal_pair(a["last"], z["first"]) for a, z in zip(segs, segs[1:], strict=False))
                out.append(row | {"id": r["id"], "no": r["no"], "first": segs[0]["first"], "last": segs[-1]["last"],
                                  "steps": joined_steps([s["steps"] for s in segs])})
            yield _batch(out, arrow)

    return work


def _edit(schema: T.StructType):
    """Segments (id, piece, pieces, state, audit, turns) -> repaired pieces."""
    def work(batches):
        arrow = _arrow(schema)
        for b in batches:
            yield _batch([{"id": r["id"], "piece": r["piece"], "pieces": r["pieces"],
                           "turns": apply_audit(r["audit"], [(t["role"], t["text"]) for t in r["turns"]], r["state"])}
                          for r in b.to_pylist()], arrow)

    return work


def _fields(**types: T.DataType) -> list[T.StructField]:
    return [T.StructField(k, v) for k, v in types.items()]


LONG, TEXT = T.LongType(), T.StringType()
STEPS = T.ArrayType(T.StructType(_fields(q=T.IntegerType(), r=T.IntegerType(), cost=LONG, audit=TEXT,
                                         joints=T.ArrayType(T.IntegerType()))))


def repair_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", segment_rows: int = SEGMENT_ROWS, fan: int = FAN) -> Repair:
    """Summary and repaired turns of every conversation; the id column keeps its name.

    ``summary``: id, n_rows, gaps (missing numbers between the least and the
    greatest turn), blank, duplicate, truncated, illegal (adjacent roles that no
    repaired conversation has), cost, audit. ``pieces``: id, piece (from 0, in
    order), pieces, turns.
    """
    col = lambda c: F.col(f"`{c}`")
    rows = rows.select(col(id_col).alias("id"), col(turn_col).cast("long").alias("turn"),
                       F.coalesce(col(role_col), F.lit(" ")).alias("role"), F.coalesce(col(text_col), F.lit(" ")).alias("text"))
    key = T.StructField("id", rows.schema["id"].dataType)
    keyed = rows.withColumn("h", F.sha2("text", 256)).withColumn("n", F.monotonically_increasing_id())
    order = ["id", "turn", "role", "h", "n"]
    cut = T.StructType([key, *_fields(whole=T.BooleanType(), part=LONG, seq=LONG, **dict.fromkeys(COUNTS, LONG),
                                      audit=TEXT, turns=T.ArrayType(TURN))])
    done, _ = stage(keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "role", "text")
                    .mapInArrow(_cut(cut, segment_rows), cut), "conversations")
    whole = done.filter("whole")
    open_summary, open_pieces = _repair_open(done.filter("NOT whole").select("id", "part", "seq", "turns"), key, fan)

    # a conversation has one row in each part; grouping also joins null ids
    turns = rows.groupBy("id").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.count_distinct("turn").alias("k"))
    gaps = turns.select("id", F.coalesce(F.expr("hi - lo + 1 - k"), F.lit(0)).alias("gaps"))
    counts = whole.select("id", *COUNTS, "audit").unionByName(open_summary)
    summary = (gaps.unionByName(counts, allowMissingColumns=True).groupBy("id")
               .agg(*[F.max(c).alias(c) for c in ("n_rows", "gaps", *COUNTS[1:], "audit")]))
    pieces = whole.select("id", F.lit(0).cast("long").alias("piece"), F.lit(1).cast("long").alias("pieces"), "turns")
    pieces = pieces.unionByName(open_pieces)
    return Repair(summary.withColumnRenamed("id", id_col), pieces.withColumnRenamed("id", id_col))


def _repair_open(segments: DataFrame, key: T.StructField, fan: int) -> tuple[DataFrame, DataFrame]:
    """Summary and pieces of conversations that are cut into ``segments`` (id, part, seq, turns)."""
    from pyspark.sql import Window

    # the number of a segment in its conversation: one narrow row per segment
    names = segments.select("id", "part", "seq")
    numbers = names.select("part", "seq", (F.row_number().over(Window.partitionBy("id").orderBy("part", "seq")) - 1)
                           .cast("long").alias("no"))
    # rows whose role and text came earlier: hashes only, the earliest place by a partial aggregate
    place = segments.select("id", "part", "seq", F.posexplode("turns").alias("pos", "t")).select(
        "id", F.sha2(F.concat_ws(":", F.length("t.role").cast("string"), "t.role", "t.text"), 256).alias("h"),
        F.struct("part", "seq", "pos").alias("at"))
    first = place.groupBy("id", "h").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = (place.alias("p").join(first.alias("f"), F.expr("p.id <=> f.id AND p.h = f.h AND p.at != f.first"))
             .select("p.at.part", "p.at.seq", "p.at.pos"))
    dups = later.groupBy("part", "seq").agg(F.collect_list("pos").alias("dups"))      # at most a segment's rows
    ready = segments.join(numbers, ["part", "seq"]).join(dups, ["part", "seq"], "left")

    base = [key, *_fields(no=LONG, **{c: LONG for c in COUNTS if c != "cost"}, first=TEXT, last=TEXT, steps=STEPS)]
    schema = T.StructType([*base, *_fields(part=LONG, seq=LONG)])
    steps, _ = stage(ready.select("id", "no", "part", "seq", "turns", "dups").mapInArrow(_segment(schema), schema), "segments")

    cols = [f.name for f in base]
    level = steps.select(*cols)
    last = steps.agg(F.max("no")).first()[0] or 0
    while last > 0:
        last //= fan
        inner = F.collect_list(F.struct(*[c for c in cols if c != "id"])).alias("segs")
        level = (level.groupBy("id", F.expr(f"no div {fan}").alias("up")).agg(inner)
                 .withColumnRenamed("up", "no").mapInArrow(_join_segments(T.StructType(base)), T.StructType(base)))
    goal = F.expr("array_min(transform(filter(steps, s -> s.q = 0 AND s.r IN (0, 3)), "
                  "s -> named_struct('cost', s.cost, 'audit', s.audit, 'joints', s.joints)))")
    solved, _ = stage(level.withColumn("goal", goal).select(
        "id", *[c for c in COUNTS if c != "cost"], "goal.cost", "goal.audit", "goal.joints"), "solved")
    summary = solved.select("id", *COUNTS, "audit")

    via = (solved.select("id", F.expr("size(joints) - 1").alias("pieces"), F.posexplode(F.expr(
        "transform(slice(joints, 1, size(joints) - 1), (q, i) -> named_struct('q', q, 'r', joints[i + 1]))")).alias("no", "via")))
    chosen = (steps.alias("s").join(via.alias("v"), F.expr("s.id <=> v.id AND s.no = v.no"))
              .select("part", "seq", F.col("s.no").alias("piece"), F.col("pieces").cast("long"), F.col("via.q").alias("state"),
                      F.expr("filter(steps, x -> x.q = via.q AND x.r = via.r)[0].audit").alias("audit")))
    out = T.StructType([key, *_fields(piece=LONG, pieces=LONG, turns=T.ArrayType(TURN))])
    pieces = (segments.join(chosen, ["part", "seq"]).select("id", "piece", "pieces", "state", "audit", "turns")
              .mapInArrow(_edit(out), out))
    return summary, pieces


def _stream_hash(schema: T.StructType):
    """Sorted (id, turns) -> id and SHA-256 of its role:text lines, one row in memory at a time."""
    def work(batches):
        arrow, here, sha, lines = _arrow(schema), None, None, 0
        for b in batches:
            out = []
            for conv, turns in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if sha is None or conv != here:
                    if sha is not None:
                        out.append({"id": here, "sha": sha.hexdigest()})
                    here, sha, lines = conv, hashlib.sha256(), 0
                for t in turns:
                    sha.update(f"{chr(10) if lines else ''}{t['role']}:{t['text']}".encode())
                    lines += 1
            if out:
                yield _batch(out, arrow)
        if sha is not None:
            yield _batch([{"id": here, "sha": sha.hexdigest()}], arrow)

    return work


def digests(pieces: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """id and ``sha``: SHA-256 of the repaired ``role:text`` lines, newline-joined.

    A hash is one chain, so a conversation of several pieces streams through one
    task in order of its pieces; none of its text is kept.
    """
    pieces = pieces.withColumnRenamed(id_col, "id")
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    one = pieces.filter("pieces = 1").select("id", F.sha2(lines, 256).alias("sha"))
    schema = T.StructType([pieces.schema["id"], T.StructField("sha", T.StringType())])
    more = (pieces.filter("pieces > 1").repartition("id").sortWithinPartitions("id", "piece").select("id", "turns")
            .mapInArrow(_stream_hash(schema), schema))
    return one.unionByName(more).withColumnRenamed("id", id_col)


def damage(rows: DataFrame) -> DataFrame:
    """Rows of ``conversations`` damaged by the crc32 of ``conv_id:turn`` (nulls: one space) modulo 20."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code: Column = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), code.alias("code")).filter("code != 0")
    text = F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), copies.alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    repair = repair_conversations(damage(rows))
    parts = rows.select("conv_id").distinct()
    for more in (repair.summary, digests(repair.pieces)):
        parts = parts.unionByName(more, allowMissingColumns=True)
    out = parts.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in ("gaps", *COUNTS[1:], "audit", "sha")])
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *COUNTS[1:])],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


#: DuckDB SQL: the cheapest edits row by row in a recursive query, without an agenda; crc32 by its table
_SQL = """
    WITH RECURSIVE
    crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    convs AS (SELECT conv_id, row_number() OVER () AS cid FROM (SELECT DISTINCT conv_id FROM conversations)),
    src AS (SELECT cid, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conversations.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
            FROM conversations JOIN convs ON conversations.conv_id IS NOT DISTINCT FROM convs.conv_id),
    code AS (SELECT src.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                    list_transform(string_split(key, ''), lambda ch: CAST(ord(ch) AS BIGINT))),
                    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS code FROM src, crc),
    hurt AS (SELECT cid, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
                    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                    unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy
             FROM code WHERE code <> 0),
    ends AS (SELECT *, left(role, 1) AS ini, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last FROM hurt),
    num AS (SELECT cid, turn, role, text, ini, last,
                   row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM ends),
    rows_ AS (SELECT *, CASE WHEN last = '' THEN 'blank'
                             WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 THEN 'duplicate'
                             WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
                     coalesce(lag(ini) OVER (PARTITION BY cid ORDER BY i) || ini NOT IN ('su', 'ua', 'au'), false) AS illegal FROM num),
    turns(q, ini, r) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
    inserts(q, r, c, a) AS (VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'),
                                   (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')),
    edits AS (SELECT cid, i, q, q AS r, 4 AS c, 'D' AS a FROM rows_, (SELECT DISTINCT q FROM inserts)
              UNION ALL
              SELECT cid, i, q, r, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, 'K' FROM rows_ JOIN turns USING (ini)
              WHERE fault NOT IN ('blank', 'duplicate')
              UNION ALL
              SELECT cid, i, q, r, CASE WHEN fault = 'truncated' THEN 6 ELSE 3 END, 'R' FROM rows_, turns
              WHERE fault NOT IN ('blank', 'duplicate') AND turns.ini IN ('u', 'a')),
    steps AS (SELECT cid, i, edits.q, inserts.r, edits.c + inserts.c AS c, edits.a || inserts.a AS a
              FROM edits JOIN inserts ON edits.r = inserts.q),
    best AS (SELECT cid, CAST(0 AS BIGINT) AS i, r AS q, {'c': c, 'a': a} AS w FROM (SELECT DISTINCT cid FROM rows_), inserts WHERE q = 0
             UNION ALL
             SELECT best.cid, best.i + 1, steps.r, min({'c': best.w.c + steps.c, 'a': best.w.a || steps.a})
             FROM best JOIN steps ON steps.cid = best.cid AND steps.i = best.i + 1 AND steps.q = best.q
             GROUP BY best.cid, best.i, steps.r),
    sums AS (SELECT cid, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal FROM rows_ GROUP BY cid),
    goal AS (SELECT best.cid, min(w) AS w FROM best JOIN sums ON sums.cid = best.cid AND sums.n = best.i WHERE q IN (0, 3) GROUP BY best.cid),
    letters AS (SELECT cid, p, substr(w.a, CAST(p AS BIGINT), 1) AS e FROM (SELECT cid, w, unnest(range(1, length(w.a) + 1)) AS p FROM goal)),
    placed AS (SELECT *, count(*) FILTER (e <> 'I') OVER (PARTITION BY cid ORDER BY p) AS i FROM letters),
    kept AS (SELECT placed.cid, p, e, rows_.role, rows_.text, rows_.ini, row_number() OVER (PARTITION BY placed.cid ORDER BY p) - 1 AS o
             FROM placed LEFT JOIN rows_ ON e <> 'I' AND rows_.cid = placed.cid AND rows_.i = placed.i WHERE e <> 'D'),
    lines AS (SELECT cid, CASE WHEN e = 'K' THEN role
                               WHEN (o - max(CASE WHEN o = 0 AND e = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY cid)) % 2 = 0 THEN 'user'
                               ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END AS line, p FROM kept),
    texts AS (SELECT cid, string_agg(line, chr(10) ORDER BY p) AS text FROM lines GROUP BY cid)
    SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(w.c, 0) AS BIGINT) AS cost,
           coalesce(w.a, '') AS audit, sha256(coalesce(texts.text, '')) AS repaired_sha256
    FROM convs LEFT JOIN sums USING (cid) LEFT JOIN goal USING (cid) LEFT JOIN texts USING (cid)"""

QUERIES = {"op11_conversation_repair": op11_conversation_repair}
ORACLE = {"op11_conversation_repair": _SQL}
