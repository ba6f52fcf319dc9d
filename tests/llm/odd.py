"""Small tables with every awkward case: nulls, empties, ties, repeated rows, names that clash."""

from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(n, at=0):
    return " ".join(WORDS[(at * 7 + i * i + i * at) % 24] + str((i * 13 + at) % 50) for i in range(n))


def documents(spark):
    long = prose(4000, 3)
    rows = [
        (1, prose(60), "en", "a"), (2, prose(60), "en", "a"), (3, prose(60) + " ", "en", None), (4, prose(59), "de", "b"),
        (5, None, "en", "a"), (6, "", None, "b"), (7, " \t\n", "en", None), (8, "ÀÉ Straße ΣΑΣ Été", "de", "c"), (9, "one", "en", "c"),
        (10, long, "en", "a"), (11, long.replace("alpha", "Alpha"), "en", "a"), (1, prose(60), "en", "a"), (None, prose(60), "en", "b"),
        (None, None, None, None), (12, "x" * 250, "en", "d"), (13, prose(30, 5) + " " + prose(40, 1), "en", "d"), (14, prose(30, 6) + " " + prose(40, 1) + "\n" + prose(9, 8), "en", "d"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return docs


def clashing(df):
    """With extra columns under names that operators use."""
    names = "score held_out predicted kept keep_id group_size host path rule verdict size target repeats n rep component token body copy spans words doc key start _extra"
    return df.withColumns({c: F.lit(7) for c in names.split() if c not in df.columns})


def empty(df):
    return df.where("1 = 0")
