"""Small tables for the operators' edge cases, and plain versions of shared rules."""

import random
import re

from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Column names that operators use inside; tables that have them too must not disturb anything.
CLASHING = ("score", "node", "token", "n", "key", "row_key", "mix_key", "mix_turn", "range", "size", "times", "quality", "toxic", "kept", "digest", "kind", "shard", "start", "label", "place")


def words(text, lower=False):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if lower else text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, lower=False, k=5):
    w = words(text, lower)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def edge_rows():
    """Nulls in every column, empty and blank texts, a very long text, repeated rows, equal ids, odd white space."""
    rng = random.Random(5)
    long = prose(rng, 60_000)
    base = prose(rng, 80)
    return [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", "en", "a", 4),
        (4, base, "en", "a", 1),
        (4, base, "en", "a", 1),
        (5, base, None, "b", None),
        (5, prose(rng, 30), "en", "b", 1),
        (6, edited(rng, base, 1), "en", None, 1),
        (7, long, "en", "b", 1),
        (8, "one two", "en", "c", 7),
        (9, "one  two\n", "en", "c", 8),
        (10, "Zeile\n\nzwei　ü \U0001f600 <|endoftext|> a   b \x01 c", "de", "c", 1),
        (None, prose(rng, 20), "en", "c", 1),
        (None, None, None, None, None),
        (-3, "You are a stupid pathetic idiot. " * 3, "en", "a", 1),
    ]


def documents(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, DOCUMENTS)
    if clashing:
        for c in CLASHING:
            df = df.withColumn(c, F.lit("clash"))
    return df


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
