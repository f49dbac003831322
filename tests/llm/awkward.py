"""Documents with every awkward case, used by several operators' tests."""

SCHEMA = "doc_id long, text string, score string, part int, `a.b` int"
PROSE = " ".join(f"word{i} and then word{i * 7 % 50}" for i in range(60))
AWKWARD = [
    (1, None), (2, ""), (3, "  \t\n "), (4, PROSE), (5, PROSE), (5, PROSE), (6, PROSE.upper()), (None, PROSE),
    (7, "one"), (8, "!!! ??? ###"), (9, "x" * 300_000), (10, "long " * 60_000), (11, "Ünïcödé ñandú straße"),
    (12, "a\x00b   tab\tand\x0bmore"), (13, "🙂 smile 🙂"), (14, "it's we'll <|endoftext|> x2½ İ"),
]


def frame(spark, pairs, partitions=3):
    rows = [(i, t, "mine", 1, 2) for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)
