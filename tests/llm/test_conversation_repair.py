import hashlib
import itertools
import random
import re
import zlib

import pytest

from strata.llm.conversation_repair import ORACLE, Row, cheapest_repair, digests, op11_conversation_repair, repair_conversations

GRAMMAR = re.compile("(s?(ua)+)?")


def exhaustive(rows):
    """Every choice of edits with up to two inserts in each gap; (cost, audit, roles) of the best."""
    best = None
    gaps = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    for ins in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product("DKua", repeat=len(rows)):
            cost, audit, roles = 0, "", ""
            for i in range(len(rows) + 1):
                audit += "I" * len(ins[i])
                cost += 3 * len(ins[i])
                roles += "".join(ins[i])
                if i < len(rows):
                    initial, must_go, cut_off = rows[i]
                    e = edits[i]
                    audit += e if e in "DK" else "R"
                    cost += {"D": 4, "K": 0}.get(e, 3) + (3 if cut_off and e != "D" else 0)
                    roles += "" if e == "D" else (initial or "?") if e == "K" else e
                    if must_go and e != "D":
                        cost = 10 ** 6
            if GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, roles)
    return best


def relaxed(rows):
    """(cost, audit) by relaxing all items until nothing changes (no agenda, no order of pops)."""
    nxt = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {(0, ""): (0, "")}
    while True:
        before = dict(best)
        for (i, q), (c, a) in before.items():
            moves = [(i, nxt[q, x], 3, "I") for x in "ua" if (q, x) in nxt]
            if i < len(rows):
                initial, must_go, cut_off = rows[i]
                extra = 3 if cut_off else 0
                moves.append((i + 1, q, 4, "D"))
                if not must_go:
                    moves += [(i + 1, nxt[q, x], 3 + extra, "R") for x in "ua" if (q, x) in nxt]
                    moves += [(i + 1, nxt[q, initial], extra, "K")] if (q, initial) in nxt else []
            for j, r, cost, e in moves:
                new = (c + cost, a + e)
                if best.get((j, r), (10 ** 9, "")) > new:
                    best[j, r] = new
        if best == before:
            return min(best[k] for k in ((len(rows), ""), (len(rows), "a")) if k in best)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        sp = lambda v: " " if v is None else str(v)
        code = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def expected(rows):
    """Result rows by conversation, in plain Python."""
    hurt, out = damaged(rows), {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in hurt if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        turns = {r[1] for r in mine if r[1] is not None}
        n = {"blank": 0, "duplicate": 0, "truncated": 0}
        info, seen = [], set()
        for _, _, role, text in mine:
            words = re.findall("[^\x20\x09-\x0d]", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            info.append(Row(role[:1] if role[:1] and role[:1] in "sua" else "", fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        cost, audit = relaxed(info)
        lines, i, last = [], 0, ""
        for e in audit:
            role, text = (mine[i][2], mine[i][3]) if e != "I" else ("", "")
            i += e != "I"
            if e == "D":
                continue
            role = role if e == "K" else "assistant" if last == "u" else "user"
            last = role[0]
            lines.append(f"{role}:{text}")
        assert GRAMMAR.fullmatch("".join(x[0] for x in lines))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal,
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_rows(seed, convs, most):
    rnd = random.Random(seed)
    texts = ["Fine.", "Fine.", "Good!", "cut off", "", " \n", "Why?  ", "é…", None, "日本。", "\x0b.\x0c"]
    return [(c, rnd.choice([t, t, t, None, t + 5]) if rnd.random() < .2 else t, rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
             rnd.choice(texts)) for c in range(convs) for t in range(rnd.randint(0, most))]


def test_agenda_against_exhaustive_search():
    rnd = random.Random(1)
    for n in (0, 1, 2, 3):
        for _ in range([1, 20, 30, 4][n]):
            rows = tuple(Row(rnd.choice("sua") if rnd.random() < .9 else "", rnd.random() < .25, rnd.random() < .3) for _ in range(n))
            assert cheapest_repair(rows) == exhaustive(rows)[:2] == relaxed(rows), rows


def test_agenda_against_relaxation():
    rnd = random.Random(2)
    for _ in range(400):
        rows = []
        for _ in range(rnd.randint(0, 14)):
            gone = rnd.random() < .2
            rows.append(Row(rnd.choice("suauaua") if rnd.random() < .9 else "", gone, not gone and rnd.random() < .3))
        assert cheapest_repair(tuple(rows)) == relaxed(rows), rows


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    got = {r[0]: tuple(r)[1:] for r in op11_conversation_repair(spark, sf).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == expected(rows)


def _table(spark, path, rows):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")


def test_nulls_ties_and_repeats(spark, tmp_path):
    rows = random_rows(4, 150, 9) + [(None, t, "user", "Hm.") for t in (1, None, 2, 2)] + [(9000, None, None, None)] * 3
    rows += [(c, 1, "user", "Once.") for c in range(10000, 10060)]      # some lose their only row
    _table(spark, tmp_path, rows)
    got = {r[0]: tuple(r)[1:] for r in op11_conversation_repair(spark, str(tmp_path)).collect()}
    want = expected(rows)
    assert got == want
    empty = hashlib.sha256(b"").hexdigest()
    assert (0, 0, 0, 0, 0, 0, "", empty) in want.values()


@pytest.mark.parametrize("segment_rows, fan", [(3, 2), (5, 4), (1, 3)])
def test_long_conversations_in_segments(spark, segment_rows, fan):
    rnd = random.Random(6)
    rows = [(7, t, rnd.choice(["user", "assistant", "user", "assistant", "system"]), rnd.choice(["Yes.", "No.", "cut", "", f"Text {t}.", f"Text {t}"])) for t in range(260)]
    rows += [(c + 100, *r) for c, *r in random_rows(8, 40, 8)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    cut = repair_conversations(df, segment_rows=segment_rows, fan=fan)
    flat = repair_conversations(df)
    pieces = cut.pieces.filter("conv_id = 7").collect()
    assert len(pieces) > 50 and {p.pieces for p in pieces} == {len(pieces)} and {p.piece for p in pieces} == set(range(len(pieces)))
    assert sorted(map(tuple, cut.summary.collect())) == sorted(map(tuple, flat.summary.collect()))
    assert sorted(map(tuple, digests(cut.pieces).collect())) == sorted(map(tuple, digests(flat.pieces).collect()))
    one = {r.conv_id: r for r in cut.summary.collect()}[7]
    mine = sorted((r for r in rows if r[0] == 7), key=lambda r: r[1])
    seen, info = set(), []
    for _, _, role, text in mine:
        gone = not text or (role, text) in seen
        seen.add((role, text))
        info.append(Row(role[0], gone, not gone and text[-1] not in ".!?"))
    assert (one.cost, one.audit) == cheapest_repair(tuple(info)) == relaxed(info)


def test_equal_rows_fill_a_conversation(spark):
    rows = [(1, 4, "user", "Same.")] * 3000 + [(2, 1, "user", "Hi."), (2, 2, "assistant", "Ho.")]
    got = repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), segment_rows=100, fan=8)
    s = {r.conv_id: r for r in got.summary.collect()}
    assert (s[1].n_rows, s[1].duplicate, s[1].illegal, s[1].cost) == (3000, 2999, 2999, 2999 * 4 + 3)
    assert s[1].audit == "K" + "D" * 2999 + "I"
    assert (s[2].cost, s[2].audit) == (0, "KK")


def test_empty_table_and_clashing_names(spark):
    schema = "conv_id string, turn long, role string, text string, id long, `part` long, audit string, turns string"
    none = repair_conversations(spark.createDataFrame([], schema))
    assert none.summary.count() == 0 and none.pieces.count() == 0 and digests(none.pieces).count() == 0
    df = spark.createDataFrame([("x", 1, "user", "A.", 1, 1, "q", "z"), ("x", 2, "assistant", "B.", 2, 2, None, None)], schema)
    assert repair_conversations(df).summary.columns[0] == "conv_id"
    assert [tuple(r) for r in repair_conversations(df).summary.collect()] == [("x", 2, 0, 0, 0, 0, 0, 0, "KK")]


def test_sql_against_plain_python():
    import duckdb
    import pandas as pd

    rows = random_rows(11, 200, 9) + [(None, t, "user", "Hm.") for t in (1, None, 2, 2)] + [(9000, None, None, None)] * 3
    rows += [(c, 1, "user", "Once.") for c in range(10000, 10060)]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = {r[0]: tuple(r[1:]) for r in con.execute(ORACLE["op11_conversation_repair"]).fetchall()}
    assert got == expected(rows)
    assert len(pd.DataFrame(got)) == 8
