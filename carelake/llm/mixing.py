"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions alone.

Every source is shuffled by the MD5 of document id, size and source. A document's virtual finish time is the number of words of its source up to and with
it, divided by the source's target. Sorted by that time, all sources advance in proportion to their targets; the order is
cut where the words taken reach the total budget. A source may go round twice; its second pass follows its first.

Running sums over a source of any size come in two steps: sums of hash buckets, whose number grows with the rows, then a
window within a bucket. The global order is cut into ranges of virtual time in the same way, and only the range that holds
the cut is looked at row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import materialise

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
#: Rows of cuts, and of documents at a cut, that may be sent to every task.
SOURCES_SENT = 10_000
#: Rows a bucket holds on average.
BUCKET_ROWS = 20_000


def _power(n: float) -> int:
    return 1 << max(0, int(n) - 1).bit_length() if n > 1 else 1


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """Adds ``target`` to ``sources`` (source, source_size): ``share`` of all sizes, dealt by weight.

    Weights repeat over the sources in code point order, null last. A target stops at ``passes`` times the source's size;
    what is above is dealt to the others by weight until none is above. With sources sorted by cap / weight that level
    is the largest of (budget - caps before) / (weights from here on). One row a source is sorted in one place.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = sources.withColumn("weight", F.get(cycle, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))))
    rows = rows.withColumn("cap", F.lit(passes) * F.col("source_size")).withColumn("budget", F.lit(share) * F.sum("source_size").over(Window.partitionBy()))
    up = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.col("budget") - before) / after)
    rows = rows.withColumn("level", F.max("level").over(Window.partitionBy()))
    return rows.withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))).drop("level", "cap", "budget")


def _size():
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _queue():
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))


def _place():
    return F.md5(F.concat_ws("/", F.col("doc_id").cast("string"), F.col("size").cast("string"), "queue"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken and times for every row of ``documents`` (doc_id, text, source).

    ``size`` is the number of words (null text: 0), ``times`` how often the mix takes the document, ``taken`` that times
    its size. Empty documents are never taken; null is a source of its own; of rows with equal id, source and size any may
    come first; an empty table gives no rows. Reruns agree, since order and cut depend on the rows alone. ``keep`` names
    further columns of ``documents`` to pass through; all others are ignored.
    """
    size = _size()
    kept = [F.col(c).alias(f"kept_{c}") for c in keep]
    base = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), *kept)
    base = materialise(base, "mixing-sizes")
    n_rows = base.count()
    sources = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    planned = materialise(targets(sources, weights, share, passes), "mixing-targets")
    n_buckets = _power(n_rows / BUCKET_ROWS)
    rows = base.withColumn("queue", _queue()).withColumn("place", _place())
    # the bucket grows with the place, so the order of a queue does not depend on the number of buckets
    rows = rows.withColumn("bucket", F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * n_buckets / 2**32).cast("long"))
    planned = planned.select(_queue().alias("queue"), "source_size", "target")
    sums = rows.groupBy("queue", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("queue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("queue", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("queue", "bucket").orderBy("place", "doc_id", "size")
    rows = rows.withColumn("number", F.row_number().over(within)).withColumn("upto", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(sums, ["queue", "bucket"]).withColumn("upto", F.col("upto") + F.col("before")).join(planned, "queue")
    columns = ["queue", "bucket", "number", "doc_id", "size", "source_size", "target", "upto", *[f"kept_{c}" for c in keep]]
    rows = materialise(rows.select(*columns), "mixing-rows")

    def finish(turn):
        return (F.col("upto") + turn * F.col("source_size")) / F.col("target")

    def place(turn):
        return F.struct(finish(turn).alias("finish"), "queue", "bucket", "number", turn.cast("int").alias("turn"))

    budget = planned.agg(F.sum("target")).first()[0] or 0.0
    n_ranges = _power(passes * n_rows / BUCKET_ROWS)
    # a copy that starts at or beyond its source's target is past the cut, since every source is through by then
    copies = rows.where("size > 0 and target > 0").withColumn("turn", F.explode(F.array(*[F.lit(t) for t in range(passes)])))
    copies = copies.where(F.col("upto") - F.col("size") + F.col("turn") * F.col("source_size") < F.col("target"))
    copies = copies.select(place(F.col("turn")).alias("place"), "size").withColumn("range", F.floor(F.least(F.col("place.finish"), F.lit(2.0)) * n_ranges))
    by_range = copies.groupBy("range").agg(F.sum("size").alias("words"))
    upto = by_range.withColumn("upto", F.sum("words").over(Window.orderBy("range")))  # one row a range
    over = upto.where(F.col("upto") > budget).orderBy("range").limit(1).collect()
    last = None
    if over:
        room = budget - (over[0]["upto"] - over[0]["words"])
        ranked = copies.where(F.col("range") == over[0]["range"]).withColumn("upto", F.sum("size").over(Window.partitionBy("range").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))
        last = ranked.where(F.col("upto") <= room).agg(F.max("place").alias("last")).first()["last"]
        cut = None if last is None else F.struct(F.lit(last["finish"]).alias("finish"), F.lit(last["queue"]).alias("queue"), F.lit(last["bucket"]).cast("long").alias("bucket"), F.lit(last["number"]).alias("number"), F.lit(last["turn"]).alias("turn"))

    def is_taken(turn: int):
        start = F.col("upto") - F.col("size") + F.lit(turn) * F.col("source_size")
        inside = (F.col("size") > 0) & (F.col("target") > 0) & (start < F.col("target"))
        if over:
            range_of = F.floor(F.least(finish(F.lit(turn)), F.lit(2.0)) * n_ranges)
            inside &= (range_of < over[0]["range"]) if cut is None else ((range_of < over[0]["range"]) | (place(F.lit(turn)) <= cut))
        return F.when(inside, 1).otherwise(0)

    times = sum((is_taken(t) for t in range(1, passes)), is_taken(0))
    out = rows.withColumn("times", times)
    return out.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "times", *[F.col(f"kept_{c}").alias(c) for c in keep])


def mixed(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """The rows of ``documents``, each as often as ``mix`` takes it; all columns pass. Null texts and sources are as in ``mix``.

    Rows with equal id, source and text are one, which is repeated as often as all of them are taken; an empty table gives
    no rows. A source is taken in the order of places, so one place for each source and turn tells which rows are taken, and texts
    are not shuffled; only rows at such a place are matched one by one, by two hashes of id, source and text.
    """
    def free(name: str) -> str:
        while name.lower() in map(str.lower, documents.columns):
            name += "_"
        return name

    key, check, origin, turns = free("mix_key"), free("mix_check"), free("mix_origin"), free("mix_turns")
    marks = {key: F.xxhash64("doc_id", "source", "text"), check: F.xxhash64(F.lit(1), "doc_id", "source", "text")}
    taken = mix(documents.select("doc_id", "source", "text", F.col("source").alias(origin), *[v.alias(k) for k, v in marks.items()]), weights, share, passes, keep=(origin, key, check))
    taken = taken.withColumn("source", F.col(origin)).withColumn("queue", _queue()).withColumn("place", _place())
    taken = materialise(taken.where("size > 0").select("queue", "place", "times", key, check), "mixing-taken")
    cuts = taken.groupBy("queue").agg(*[F.max(F.when(F.col("times") > t, F.col("place"))).alias(f"cut_{t}") for t in range(passes)])
    cuts = materialise(cuts, "mixing-cuts")
    names = [f"cut_{t}" for t in range(passes)]
    at_cut = F.coalesce(F.array_contains(F.array(*names), F.col("place")), F.lit(False))
    small = cuts.limit(SOURCES_SENT + 1).count() <= SOURCES_SENT  # one row a source: sent to all tasks unless there are very many
    side = F.broadcast(cuts) if small else cuts
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole")
    rows = documents.select(whole, F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), F.col("text").cast("string").alias("text"))
    # words are counted in one projection: a filter on them would be pushed down and count them again
    rows = rows.withColumn("size", _size()).withColumn("queue", _queue()).withColumn("place", _place()).select("whole", "size", "queue", "place").join(side, "queue")
    counts = [F.when((F.col("size") > 0) & (F.col("place") < F.col(c)), 1).otherwise(0) for c in names]
    # equal rows below a cut: all are taken equally often, so it does not matter that each stands for itself
    plain = rows.select("whole", F.when(at_cut & (F.col("size") > 0), 0).otherwise(sum(counts[1:], counts[0])).alias(turns))
    edge = materialise(taken.join(side, "queue").where(at_cut).groupBy(key, check).agg(F.sum("times").cast("int").alias(turns)), "mixing-edge")
    edge = F.broadcast(edge) if edge.limit(SOURCES_SENT + 1).count() <= SOURCES_SENT else edge
    edge = documents.select(whole, *[v.alias(k) for k, v in marks.items()]).join(edge, [key, check]).dropDuplicates([key, check]).select("whole", turns)
    out = plain.unionAll(edge).where(F.col(turns) > 0)
    return out.select("whole", F.explode(F.sequence(F.lit(1), F.col(turns)))).select("whole.*")
