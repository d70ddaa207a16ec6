"""Document fingerprints by consistent weighted sampling (operator 8), in DataFrame functions only.

The terms of a text are its words; a word's weight is its count times the
square of its length (in code points, 31 at most), so that the few short words
of a language do not make all its texts alike. For each of ``SAMPLES`` samples
and each term, two gamma variates and a uniform one are drawn from hashes of
the term (Ioffe's improved consistent weighted sampling); the sample is the
term, and the step of its weight, with the least value. Two texts agree in a
sample with a probability equal to the generalised Jaccard similarity of their
weights, sum of minima over sum of maxima. A gamma variate of shape 2 is the
sum of two exponential ones, each the negative logarithm of a 16-bit uniform
number, read from a table that a scalar subquery computes once.

A text's words are sorted and counted inside its row; the (term, count) runs
are exploded and aggregated by minimum where they are, since rows are already
partitioned by document. A sample's value and identity are one long (value in
the upper, identity in the lower half), so the aggregation runs on hash maps
of longs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firelog.llm.common import stored

SAMPLES = 32
# Exponential variates on a grid of this many uniform numbers.
GRID = 1 << 16
# Samples computed per exploded row: keeps the generated code within the size the JIT compiles.
GROUP = 4
NO_ID = -(1 << 63)
_SPLIT = r"[\x20\x09-\x0D]+"


def succession(rows: DataFrame) -> DataFrame:
    """``(id, next_id, prev_id, prev_quarter)`` of every ``id`` of ``rows(id, text)``, in a circle by ascending id.

    Ids are range-partitioned and written once with their partition's
    number; neighbours are found inside the partitions, and those across
    borders from one row per partition. ``prev_quarter`` is the longest
    quarter, in code points, of the previous id's texts.
    """
    ids = rows.groupBy("id").agg(F.max(F.expr("length(text) div 4")).cast("int").alias("quarter"))
    ids = stored(ids.repartitionByRange("id").withColumn("part", F.spark_partition_id()), "succession")
    inside = Window.partitionBy("part").orderBy("id")
    ends = ids.groupBy("part").agg(F.min("id").alias("first"), F.max("id").alias("last"),
                                   F.max_by("quarter", "id").alias("last_quarter"))
    parts = Window.orderBy("part")  # one row per partition
    all_parts = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        F.col("part").alias("part_"),
        F.coalesce(F.lead("first").over(parts), F.first("first").over(all_parts)).alias("after"),
        F.coalesce(F.lag("last").over(parts), F.last("last").over(all_parts)).alias("before"),
        F.coalesce(F.lag("last_quarter").over(parts), F.last("last_quarter").over(all_parts)).alias("before_quarter"))
    near = ids.select("id", "part", F.lead("id").over(inside).alias("n"), F.lag("id").over(inside).alias("p"),
                      F.lag("quarter").over(inside).alias("q"))
    return stored(near.join(ends, F.col("part") == F.col("part_")).select(
        "id", F.coalesce("n", "after").alias("next_id"), F.coalesce("p", "before").alias("prev_id"),
        F.when(F.col("p").isNull(), F.col("before_quarter")).otherwise(F.col("q")).alias("prev_quarter")), "succession")


def _words(text: Column, tag: int) -> Column:
    """Hash, length and ``tag`` of every word in a long: hash in the upper 58 bits, length in the next five, tag in the last."""
    words = F.filter(F.split(text, _SPLIT), lambda w: w != "")
    return F.transform(words, lambda w: F.shiftleft(F.shiftright(F.xxhash64(w), 6), 6).bitwiseOR(
        F.least(F.length(w), F.lit(31)).cast("long") * 2 + tag))


def term_runs(rows: DataFrame, first: str, second: str, keep: list[str]) -> DataFrame:
    """One row per distinct term of either text: ``keep``, ``term`` (hash and length), its counts ``n0`` and ``n1``.

    The explode is an outer one on purpose: for an inner one the optimizer
    infers a filter on the array's size and moves it below the projections,
    which would sort a text's words again for each of them.
    """
    packed = rows.select(*keep, F.sort_array(F.concat(_words(F.col(first), 0), _words(F.col(second), 1))).alias("w"))
    packed = packed.select(*keep, "w", F.size("w").alias("k"))
    starts = packed.select(*keep, "w", "k", F.expr(
        "filter(if(k > 0, sequence(0, k - 1), array()), i -> i = 0 or w[i] <> w[i - 1])").alias("s"))
    counted = starts.select(*keep, F.expr(
        "transform(s, (a, j) -> struct(w[a] as v, coalesce(get(s, j + 1), k) - a as n))").alias("r"))
    # runs of one term in the two texts are neighbours: v with tag 0, then v + 1
    merged = counted.select(*keep, F.expr("""
        transform(r, (x, j) -> case
            when x.v % 2 = 0 then struct(shiftright(x.v, 1) as term, x.n as n0, if(get(r, j + 1).v = x.v + 1, get(r, j + 1).n, 0) as n1)
            when get(r, j - 1).v = x.v - 1 then null
            else struct(shiftright(x.v, 1) as term, 0 as n0, x.n as n1) end)""").alias("t"))
    return merged.select(*keep, F.explode_outer("t").alias("t")).where("t is not null").select(*keep, "t.term", "t.n0", "t.n1")


def _uniform(bits: Column) -> Column:
    """(0, 1) from the upper or lower 32 bits given as a non-negative long."""
    return (bits.cast("double") + F.lit(0.5)) * F.lit(2.0 ** -32)


def _exponentials(spark) -> Column:
    """Negative logarithms of ``GRID`` uniform numbers, as an array computed once per query."""
    return spark.range(1).select(F.expr(f"transform(sequence(0, {GRID - 1}), i -> -ln((i + 0.5D) / {GRID}))")).scalar()


def samples(terms: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the arrays ``sig0`` and ``sig1`` of ``SAMPLES`` sample identities of either text."""
    low = F.lit(0xFFFFFFFF).cast("long")
    length = F.col("term").bitwiseAND(F.lit(31)).cast("double")
    grid = _exponentials(terms.sparkSession)
    js = range(GROUP)
    weight = lambda n: F.when(F.col(n) > 0, F.ln(F.col(n).cast("double") * length * length))
    t = terms.select(*keys, "term", weight("n0").alias("w0"), weight("n1").alias("w1"),
                     F.explode(F.sequence(F.lit(0), F.lit(SAMPLES // GROUP - 1))).alias("g"))
    t = t.select(*keys, "g", "term", "w0", "w1", *[F.xxhash64("term", F.col("g") * GROUP + j).alias(f"a{j}") for j in js])

    def gamma(j: int, shift: int) -> Column:
        part = lambda by: grid[F.shiftrightunsigned(f"a{j}", by).bitwiseAND(F.lit(GRID - 1)).cast("int")]
        return part(shift) + part(shift + 16)

    t = t.select(*keys, "g", "term", "w0", "w1", *[gamma(j, 0).alias(f"r{j}") for j in js],
                 *[F.ln(gamma(j, 32)).alias(f"c{j}") for j in js],
                 *[_uniform(F.xxhash64(f"a{j}").bitwiseAND(low)).alias(f"u{j}") for j in js])
    t = t.select(*keys, "g", "term", *[f"{x}{j}" for x in "rcu" for j in js],
                 *[F.floor(F.col(f"w{i}") / F.col(f"r{j}") + F.col(f"u{j}")).alias(f"t{i}_{j}") for j in js for i in (0, 1)])

    def packed(i: int, j: int) -> Column:
        at = F.col(f"t{i}_{j}")
        value = F.col(f"c{j}") - F.col(f"r{j}") * (at - F.col(f"u{j}") + 1)
        # monotone in the value: 2**-24 steps from -64 to 63; no value where the text lacks the term
        step = ((F.least(F.greatest(value, F.lit(-64.0)), F.lit(63.0)) + 64) * float(1 << 24)).cast("long")
        return F.when(at.isNotNull(), F.shiftleft(step, 32).bitwiseOR(F.xxhash64("term", at).bitwiseAND(low)))

    best = t.groupBy(*keys, "g").agg(*[F.min(packed(i, j)).alias(f"m{i}_{j}") for i in (0, 1) for j in js])
    parts = [F.array(*[F.col(f"m{i}_{j}").bitwiseAND(low) for j in js]).alias(f"x{i}") for i in (0, 1)]
    both = best.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("g", *parts))).alias("parts"))
    return both.select(*keys, *[F.expr(f"flatten(transform(parts, a -> a.x{i})) as sig{i}") for i in (0, 1)])


def _whole(sig: Column) -> Column:
    """The signature, or that of a text without words (all zeros)."""
    return F.when((F.size(sig) == SAMPLES) & sig[0].isNotNull(), sig).otherwise(F.array_repeat(F.lit(0).cast("long"), SAMPLES))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(SAMPLES))


def as_hex(sig: Column) -> Column:
    return F.lower(F.array_join(F.transform(sig, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` of every row.

    The edited text has its last quarter replaced by the beginning of the
    next document's text. A null text is taken as empty; a text without words
    has the fingerprint of zeros. Of several rows with one id the first by
    text stands for it as the next document; a null id counts as the smallest
    one. Repeated rows give repeated results; other columns are not read.
    """
    # the id is made non-null so that no filter parts the two uses of the texts' one shuffle
    rows = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    order = succession(rows)
    dealt = rows.repartition("id")
    by_text = Window.partitionBy("id").orderBy("text")
    heads = (dealt.withColumn("rn", F.row_number().over(by_text)).where("rn = 1").join(order.select("id", "prev_id", "prev_quarter"), "id")
             .select(F.col("prev_id").alias("for_id"), F.expr("substring(text, 1, prev_quarter)").alias("head")))
    pairs = dealt.withColumn("rn", F.row_number().over(by_text)).join(heads, F.col("id") == F.col("for_id"), "left").select(
        "id", "rn", "text", F.length("text").alias("n_chars"), F.expr("length(text) div 4").cast("int").alias("q"), "head")
    pairs = pairs.select("id", "rn", "text", "n_chars", F.concat(
        F.expr("substring(text, 1, n_chars - q)"), F.coalesce(F.expr("substring(head, 1, q)"), F.lit(""))).alias("edited"))
    sigs = samples(term_runs(pairs, "text", "edited", ["id", "rn"]), ["id", "rn"])
    about = pairs.select("id", "rn", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    done = stored(about.join(sigs, ["id", "rn"], "left").select(
        "id", "rn", "n_chars", "edited_sha256", _whole(F.col("sig0")).alias("own"), _whole(F.col("sig1")).alias("edited")), "fingerprints")
    nexts = done.where("rn = 1").join(order.select("id", "prev_id"), "id").select(
        F.col("prev_id").alias("for_id"), F.col("own").alias("next"))
    out = done.join(nexts, F.col("id") == F.col("for_id"))
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256",
                      as_hex(F.col("own")).alias("fingerprint"), as_hex(F.col("edited")).alias("edited_fingerprint"),
                      likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"))
