"""Rows that are easy to get wrong, for every operator on documents."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, node string, key int, `_mix` string, `_epoch` int, held_out boolean")

PROSE = "the quick brown fox jumps over the lazy dog and runs through the wide green field again"


def rows():
    long = " ".join(f"w{i % 997}x{i % 13}" for i in range(40_000))
    texts = [
        (1, PROSE), (2, PROSE), (3, PROSE + " today"), (4, ""), (5, None), (6, " \t\n "), (7, "one two"),
        (8, "one two"), (9, long), (9, long), (10, "é🎉 ünïcode 日本語 テキスト"), (None, PROSE), (None, None),
        (11, "a" * 5000), (12, "the " * 300), (12, "another text with the same id, which is longer than five words"),
    ]
    return [(i, t, None if n % 5 == 0 else "en", None if n % 4 == 0 else f"s{n % 3}", None if t is None else len(t),
             0.5, "x", n, "m", n, True) for n, (i, t) in enumerate(texts)]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return frame(spark).limit(0)
