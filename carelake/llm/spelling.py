"""Spelling variants: words one edit apart, found by sorting permuterm rotations, and the form each one points to.

A word ``xcy`` with a terminator has the rotation ``y$x`` + ``c``, which starts behind the character ``c``. Leaving out that last
character gives the prefix ``y$x`` that all words with another character there share (replacements), and that is itself a
whole rotation of the word ``xy`` (insertions and deletions). So rotations are cut before their last character, sorted with the
whole ones, and each group of equal keys is scanned: all its members are neighbours. A group holds at most one word per
character of the alphabet and one without it, whatever the number of words. Of a run of equal characters only the first one's
gap is matched with whole rotations, so every pair is found in exactly one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.session import materialise

#: Words have at least so many code points and occurrences; a form has at least so many times the occurrences of its variant.
SHORTEST, LEAST, TIMES = 6, 5, 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LETTERS = "[A-Za-zÀ-ÿ]+"
#: Sorts before every letter and is none.
_END = "$"


def runs(text: Column) -> Column:
    """The maximal runs of letters of a text, with only A-Z in lower case."""
    # lower() changes nothing else in a text of one-byte characters, and is much cheaper than translate()
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.regexp_extract_all(low, F.lit(_LETTERS), F.lit(0))


def damaged(run: Column, doc_id: Column) -> Column:
    """The run without one code point where a hash of document and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % 199 == 0, cut).otherwise(run)


def word_counts(words: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n) of a column ``word``: those long and frequent enough. Counts are summed in each task before the shuffle."""
    long = words.where(F.length("word") >= shortest)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """(key, word, n, role): every rotation of each marked word, whole (role 0) or cut before its last character.

    A cut one has role 1 where its character differs from the one before it in the word, else role 2.
    """
    at = F.posexplode(F.sequence(F.lit(0), F.length("word")))
    rows = words.select("word", "n", at.alias("_", "i"))
    before, here = F.substring("word", F.lit(1), F.col("i")), F.substring("word", F.col("i") + 1, F.lit(1))
    after = F.substring("word", F.col("i") + 1, F.length("word"))
    shorter = F.substring("word", F.col("i") + 2, F.length("word"))
    first = (F.col("i") == 0) | (here != F.substring("word", F.col("i"), F.lit(1)))
    whole = F.struct(F.concat(after, F.lit(_END), before).alias("key"), F.lit(0).alias("role"))
    cut = F.struct(F.concat(shorter, F.lit(_END), before).alias("key"), F.when(first, 1).otherwise(2).alias("role"))
    both = F.when(F.col("i") < F.length("word"), F.array(whole, cut)).otherwise(F.array(whole))
    return rows.select("word", "n", F.explode(both).alias("r")).select("r.key", "word", "n", "r.role")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours within each group of equal keys; rows come sorted by key, and a group may go on in the next batch."""
    held: pa.Table | None = None

    def scan(rows: pa.Table) -> pa.RecordBatch | None:
        key = rows.column(0).combine_chunks()
        if not len(key):
            return None
        begins = pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate(([True], begins)))
        sizes = np.diff(np.append(starts, len(key)))
        role = rows.column(3).to_numpy()
        left, right = [], []
        for size in np.unique(sizes[sizes > 1]):  # at most one word per letter, so there are few sizes
            at = starts[sizes == size][:, None] + np.arange(size)
            a, b = np.repeat(at, size, axis=1).ravel(), np.tile(at, size).ravel()
            near = (a != b) & ((role[a] > 0) & (role[b] > 0) | (role[a] + role[b] == 1))
            left.append(a[near])
            right.append(b[near])
        if not left:
            return None
        a, b = np.concatenate(left), np.concatenate(right)
        word, n = rows.column(1).combine_chunks(), rows.column(2).combine_chunks()
        return pa.RecordBatch.from_arrays([word.take(pa.array(a)), word.take(pa.array(b)), n.take(pa.array(b))], names=["word", "near", "near_n"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        key = rows.column(0).combine_chunks()
        last = len(key) - 1
        while last and key[last - 1] == key[len(key) - 1]:
            last -= 1
        if len(key):
            out = scan(rows.slice(0, last))
            held = rows.slice(last)
            if out is not None:
                yield out
    if held is not None and (out := scan(held)) is not None:
        yield out


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near, near_n) for all pairs of words one inserted, deleted or replaced code point apart, in both directions."""
    placed = rotations(words).repartition("key").sortWithinPartitions("key")
    return placed.mapInArrow(_pairs, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form) whose chains end: the last form of each chain, found by doubling steps.

    A word is the form of a bounded number of others (one edit), so no key is hot.
    """
    links = materialise(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = links.join(ahead, "root", "left")
        if longer.where("further is not null").isEmpty():
            return links
        links = materialise(longer.select("word", F.coalesce("further", "root").alias("root")), "spelling-forms")


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table of distinct words and their counts (word, n).

    ``form`` is the near word of largest n (ties: the smallest in code-point order) if it has ``times`` the occurrences, else
    null; ``root`` is the end of the chain of forms. Words without neighbours have n_near 0 and are their own root.
    """
    words = materialise(words.select("word", "n"), "spelling-words")
    # the largest n first, then the smallest word: both as one minimum, summed up in each task before the shuffle
    best = F.min(F.struct((-F.col("near_n")).alias("down"), F.col("near").alias("near"))).alias("best")
    near = neighbours(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(near, "word", "left").withColumn("most", -F.col("best.down"))
    holds = F.col("most") >= times * F.col("n")
    rows = joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(holds, F.col("best.near")).alias("form"), F.when(holds, F.col("most")).alias("form_n"))
    rows = materialise(rows, "spelling-variants")
    chained = rows.join(roots(rows.where("form is not null")), "word", "left")
    return chained.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_variants(documents: DataFrame) -> DataFrame:
    """Variants among the words of whole texts, of which some have lost a code point by a hash of document and word.

    Null and empty texts have no words; a null doc_id counts as an empty one in the hash; repeated rows count repeatedly; other
    columns are ignored; an empty table gives no rows. The runs of one text are one array in a task, about 60 bytes a run.
    """
    doc_id, text = F.col("doc_id"), F.col("text").cast("string")
    run = documents.select(doc_id, F.explode(runs(text)).alias("run"))
    return variants(word_counts(run.select(damaged(F.col("run"), F.col("doc_id")).alias("word"))))
