"""Documents with every awkward property: nulls, empty and very long
texts, ties, repeated rows, columns whose names clash."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, score double, fp long, id long, "
          "copies int, component_id long, ids array<int>, u long, shard int, bucket string, row string, text__ string, node int")


def words(n, seed, letters="abcdefgh"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n))


def rows():
    passage = words(70, 99)
    long = words(30_000, 5)
    texts = [
        (0, passage), (1, words(40, 1) + "\n" + passage + " " + words(20, 2)), (2, None), (3, ""), (4, " \t\n "),
        (5, long), (6, long + " tail"), (7, words(200, 7)), (7, words(200, 7)), (8, words(200, 7)), (9, "a " * 500),
        (10, " "), (11, "###!!"), (None, passage), (None, None), (12, passage + " " + passage), (13, "Été ÉTÉ été ça"),
        (14, words(120, 14) + "\n" + words(120, 15)), (15, words(120, 14) + "\n" + words(119, 15)), (-3, words(60, 3)),
    ]
    return [(i, t, (None, "en", "fr")[k % 3], (None, "s1", "s2", "s3")[k % 4], None, -1, -1.0, 7, 7, 7, 7, [1], 7, 7, "x", "r", "t", 2)
            for k, (i, t) in enumerate(texts)]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
