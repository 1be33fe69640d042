"""Small document tables with the awkward cases."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau upsilon Été ΣΑΣ naïve übung".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(400)) for _ in range(n))


def documents() -> list[tuple]:
    base, passage = prose(1, 120), prose(2, 60)
    texts = {
        1: base, 2: base, 3: base.replace(" ", "\n", 3) + " ", 4: base + " one more", 5: None, 6: "", 7: " \t\n", 8: "word", 9: "two words", 10: prose(3, 30) + " " + passage + " " + prose(4, 30), 11: passage + "  " + prose(5, 40),
        12: prose(6, 9) + "\x0b" + prose(7, 9), 13: "a" * 450, 14: (prose(8, 12) + " ") * 8, 15: prose(9, 6000), 16: prose(9, 6000)[:-3], 17: "Ünïcode " + prose(10, 50) + " ｆｕｌｌ", 18: prose(11, 100), 19: " ".join(prose(11, 100).split()[:97] + ["x1", "x2", "x3"]), 20: "don't stop.\nGo 12,5 on!",
    }
    return [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def clashing(df):
    """Columns that an operator might use inside."""
    from pyspark.sql import functions as F

    for c in ("id", "key", "bucket", "block", "kind", "payload", "score", "tox_score", "_xd_key", "n", "a", "b"):
        df = df.withColumn(c, F.lit("own"))
    return df
