import sys

sys.path.insert(0, __file__.rsplit("/", 2)[0])
from oracle_compare import compare, connect  # noqa: E402

from bayline.llm import chats, oracle  # noqa: E402
from bayline.llm.common import table  # noqa: E402

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn int, role string, text string, block string, at int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def found(df):
    return {(r.conv_id, r.piece): (r.n_turns, r.copies, r.text) for r in df.collect()}


def shown(*turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def test_matches_sql(spark):
    assert compare(chats.formatted(table(spark, SF, "conversations")), connect(SF), oracle.CHATS) is None


def test_snapshots_collapse(spark, monkeypatch):
    monkeypatch.setattr(chats, "BLOCK", 3)
    talk = [("user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(12)]
    rows = [(n, i, *talk[i]) for n in (3, 7, 12) for i in range(n)]          # a growing log
    rows += [(20, i, *talk[i]) for i in range(12)]                            # a copy of the longest
    rows += [(30, i, *(talk[i] if i < 6 else ("user", "else"))) for i in range(8)]  # a branch
    rows += [(40, i + 5, *talk[i + 1]) for i in range(4)]                     # the middle of one
    got = found(chats.formatted(frame(spark, rows), piece=8))
    assert got.keys() == {(12, 0), (12, 1), (30, 0), (40, 0)}
    assert got[12, 0] == (12, 2, shown(*talk[:8])) and got[12, 1][2] == shown(*talk[8:])
    assert got[40, 0] == (4, 1, shown(*talk[1:5]))


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, None, None),          # repeated row, nulls
        (2, 0, "user", "a"), (2, 1, "", ""), (2, 2, "user", "z"),              # 1 is a snapshot of 2
        (None, 0, "user", "a"), (3, None, "user", "first"), (3, -5, "user", "then"),
        (4, 0, "user", "long " * 20_000), (5, 7, "user", "p"), (5, 7, "user", "q"),
    ]
    got = found(chats.formatted(frame(spark, rows)))
    assert got.keys() == {(2, 0), (3, 0), (4, 0), (5, 0)}
    assert got[2, 0][:2] == (3, 1) and got[3, 0][2] == shown(("user", "first"), ("user", "then"))
    assert len(got[4, 0][2]) > 100_000 and got[5, 0][0] == 2
    assert chats.formatted(frame(spark, rows).limit(0)).count() == 0
