"""License scan (operator 4): ordered signature rules with keyword prefilter and interval containment.

Texts are lower-cased (A-Z) and read as words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
Word counts come from byte tables over whole Arrow batches. Only texts that
hold one of the gate words are normalised (words joined by one space) and
matched: first the base phrases at every place, then each rule of whose
necessary words one occurs. The gate is the necessary words of all phrases and
rules, derived from their patterns, so a text without one has no detection. A detection that lies inside one of higher priority, or inside a longer
one of the same priority, is suppressed; with equal intervals the earlier rule wins.

No shuffle and no join: each text is judged in the task that reads it, so a hot
source or a very long text costs its own length only.

Defined results: null and empty texts have no words and no detections; repeated
rows and ids are judged row by row; other columns are ignored.
"""

from __future__ import annotations

import bisect
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import LOWER_BYTES, table, utf8
from strata.llm.license_rules import build_rules, necessary_words

# The base phrases and their labels
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
BASE_WEIGHT = 0.9

IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = True
IS_WORD[0x61:0x7B] = True
IS_WORD[0x80:] = True
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

DETECTION = T.StructType([
    T.StructField("rule", T.StringType()), T.StructField("label", T.StringType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("priority", T.IntegerType()), T.StructField("weight", T.DoubleType()),
    T.StructField("base", T.BooleanType()), T.StructField("kept", T.BooleanType())])


def suppress(found: list[tuple]) -> list[bool]:
    """Which detections (start, end, priority, rule order) stay, in O(n log n).

    Higher priorities first; within one priority longer intervals of a start
    come first, so a container is always seen before what it contains.
    """
    order = sorted(range(len(found)), key=lambda i: (-found[i][2], found[i][0], -found[i][1], found[i][3]))
    kept = [False] * len(found)
    starts, ends = [], []      # of higher priorities: starts sorted, ends as a running maximum
    at = 0
    while at < len(order):
        level = found[order[at]][2]
        own, reach = [], -1
        while at < len(order) and found[order[at]][2] == level:
            i = order[at]
            s, e = found[i][:2]
            j = bisect.bisect_right(starts, s)
            if not (e <= reach or (j and ends[j - 1] >= e)):
                kept[i] = True
            reach = max(reach, e)
            own.append((s, e))
            at += 1
        both = sorted([*zip(starts, ends, strict=True), *own])
        starts, ends, top = [], [], -1
        for s, e in both:
            top = max(top, e)
            starts.append(s)
            ends.append(top)
    return kept


class Scanner:
    """The compiled rules; one per task."""

    def __init__(self, base, rules):
        self.base = [(f"base:{p}", label, (" " + p + " ").encode(), len(p.split())) for p, label in base]
        self.rules = [(rid, label, prio, key.encode(), re.compile(rf"(?<= )(?:{pat})(?= )".encode()), w)
                      for rid, label, prio, key, pat, w in rules]
        needs = [necessary_words(pat) for _, _, _, _, pat, _ in rules]
        self.needs = [None if n is None else {w.encode() for w in n} for n in needs]
        self.words = sorted(set().union(*[n for n in self.needs if n]))

    def gate(self) -> list[bytes] | None:
        """Words of which every text with a detection has one; None if every text must be scanned."""
        phrases = [necessary_words(re.escape(rid.removeprefix("base:"))) for rid, *_ in self.base]
        if None in self.needs or None in phrases:
            return None
        return sorted({*self.words, *(w.encode() for n in phrases for w in n)})

    def scan(self, text: bytes) -> list[tuple]:
        """Detections in one lower-cased text; ``start`` and ``end`` are word numbers, end exclusive."""
        words = WORD.findall(text)
        norm = b" " + b" ".join(words) + b" "
        at = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)   # the space before word k
        out = []
        for rid, label, phrase, n in self.base:
            i = norm.find(phrase)
            while i >= 0:
                k = int(np.searchsorted(at, i))
                out.append([rid, label, k, k + n, 0, BASE_WEIGHT, True, True])
                i = norm.find(phrase, i + 1)
        found, rows = [], []
        held = {w for w in self.words if w in norm}
        for order, (rid, label, prio, key, rx, weight) in enumerate(self.rules):
            needs = self.needs[order]
            if key not in norm or (needs is not None and held.isdisjoint(needs)):
                continue
            for m in rx.finditer(norm):
                s = int(np.searchsorted(at, m.start() - 1))
                e = int(np.searchsorted(at, m.end()))
                found.append((s, e, prio, order))
                rows.append([rid, label, s, e, prio, weight, False, False])
        for row, stay in zip(rows, suppress(found), strict=True):
            row[-1] = stay
            out.append(row)
        return out


def _scan_batches(id_col, text_col, base, rules, gate):
    def run(batches):
        scanner = Scanner(base, rules)
        gates = scanner.gate() if gate is None else [g.encode() for g in gate]
        out_type = pa.list_(pa.struct([
            ("rule", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
            ("priority", pa.int32()), ("weight", pa.float64()), ("base", pa.bool_()), ("kept", pa.bool_())]))
        names = [f.name for f in DETECTION]
        for b in batches:
            raw, offs = utf8(b.column(text_col))
            low = LOWER_BYTES[raw]
            word = IS_WORD[low]
            begin = word.copy()
            begin[1:] &= ~word[:-1]
            first = offs[:-1][offs[:-1] < offs[1:]]
            begin[first] = word[first]
            total = np.concatenate([[0], np.cumsum(begin)])
            n_words = total[offs[1:]] - total[offs[:-1]]
            # a space for every byte outside of words, and one before each text and after the last
            buf = np.insert(np.where(word, low, np.uint8(32)), offs, 32).tobytes()
            at = offs + np.arange(len(offs))
            hit = np.full(len(offs) - 1, gates is None)
            for g in gates or []:
                i = buf.find(g)
                while i >= 0:
                    d = int(np.searchsorted(at, i, side="right")) - 1
                    hit[d] = True
                    i = buf.find(g, int(at[d + 1]))     # on to the next text
            found = [[] for _ in range(len(hit))]
            for d in np.flatnonzero(hit):
                found[d] = [dict(zip(names, r, strict=True)) for r in scanner.scan(buf[at[d] + 1:at[d + 1]])]
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), pa.array(n_words, pa.int64()), pa.array(found, out_type)],
                names=[id_col, "n_words", "detections"])

    return run


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  base=None, rules=None, gate=None) -> DataFrame:
    """id, ``n_words`` and ``detections`` (rule, label, word span, priority, weight, base, kept) per row."""
    schema = T.StructType([docs.schema[id_col], T.StructField("n_words", T.LongType()),
                           T.StructField("detections", T.ArrayType(DETECTION))])
    base = BASE if base is None else base
    if gate is not None:     # a base phrase passes a given gate through its longest word
        gate = list(dict.fromkeys([*gate, *(max(p.split(), key=len) for p, _ in base)]))
    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(
        _scan_batches(id_col, text_col, base, build_rules() if rules is None else rules, gate), schema)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("detections", lambda x: x["base"])
    kept = F.filter("detections", lambda x: x["kept"])
    labels = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda x: x["label"]))), ",")
    starts = F.transform(base, lambda x: x["start"])
    return d.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(kept).alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda x: x["weight"])), F.lit(0.0)).alias("score"))


QUERIES = {"op4_license_scan": op4_license_scan}
ORACLE = {}
