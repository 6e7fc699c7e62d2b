"""SpotSigs fingerprints with DataFrame functions only.

A signature is a common word (an anchor) with the content words that follow it, other anchors left out. A text's
fingerprint is its set of hashed signatures. Fingerprints are partitioned by their size and compared by a Jaccard
similarity that sizes far apart rule out beforehand.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Common words of four languages, the anchors of signatures.
ANCHORS = {
    "en": "the a an of to and in is that for it as was with be by on at from this or are".split(),
    "de": "der die das und ist in zu den von mit sich auf ein eine nicht als auch".split(),
    "fr": "le la les de des et est en un une du que qui dans pour au".split(),
    "es": "el los las y que se del con por su para como es lo".split(),
}
CHAIN = 3
RANGES, PIECES = 128, 64


def anchor_pattern() -> str:
    return "|".join(sorted({w for words in ANCHORS.values() for w in words}))


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The sorted distinct 32-bit hashes of a text's signatures.

    A text without a whole chain has its words for signatures, and one without words, or null, itself.
    """
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]++", " "), F.lit(" "))
    marked = F.regexp_replace(words, f" (?=(?:{anchor_pattern()}) )", " #")
    # each anchor is followed, between \x01 and \x02, by itself and the next words without a mark
    follow = "".join(r"(?: #\S++)*+ ([^#\s]\S*+)" for _ in range(chain))
    chained = F.regexp_replace(marked, rf"#(\S++)(?={follow})", "\x01" + " ".join(f"${k}" for k in range(1, chain + 2)) + "\x02")
    spots = F.regexp_extract_all(chained, F.lit("\x01([^\x02]++)\x02"), F.lit(1))
    plain = F.filter(F.split(words, " "), lambda w: w != "")
    chosen = F.when(F.size(spots) > 0, spots).when(F.size(plain) > 0, plain).otherwise(F.array(F.coalesce(text, F.lit(""))))
    return F.array_sort(F.array_distinct(F.transform(chosen, lambda s: F.hash(s))))


def written(sigs: Column) -> Column:
    """A fingerprint as text: eight hex digits a signature."""
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(s.cast("long").bitwiseAND(0xFFFFFFFF))), 8, "0")), "")


def size_partition(size: Column, least: float) -> Column:
    """Number of the size range of a set: sets in ranges further apart than one can not reach ``least``."""
    return F.floor(F.log(size.cast("double")) / F.lit(-log(least))).cast("int")


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two signature sets, of which none is empty."""
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def pruned_jaccard(a: Column, b: Column, least: float) -> Column:
    """Similarity of two signature sets; 0 without a look at them where their length partitions or sizes keep it below ``least``."""
    n, m = F.size(a), F.size(b)
    apart = F.abs(size_partition(n, least) - size_partition(m, least)) > 1
    return F.when(apart | (F.least(n, m) < F.greatest(n, m) * F.lit(least)), F.lit(0.0)).otherwise(jaccard(a, b))


def near_pairs(docs: DataFrame, least: float = 0.8, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """(id_a, id_b, similarity) of classes of equal fingerprints, each by its smallest id, at ``least`` or above.

    Within a size range and the next one, sets meet on their prefixes only: in the order of the hash, two sets as
    similar as ``least`` share one of their first n - ceil(least * n) + 1 signatures. Rows with a null id take no part.
    """
    rows = docs.where(F.col(row_id).isNotNull()).select(F.col(row_id).alias("id"), signatures(F.col(text)).alias("sigs"))
    classes = rows.groupBy("sigs").agg(F.min("id").alias("id")).withColumn("n", F.size("sigs")).withColumn("part", size_partition(F.col("n"), least))
    prefix = F.slice("sigs", 1, (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int"))
    keyed = classes.select("id", "n", "part", F.explode(prefix).alias("sig"))
    ahead = keyed.select(F.col("id").alias("id_b"), F.col("n").alias("n_b"), F.explode(F.array("part", F.col("part") - 1)).alias("part"), F.col("part").alias("part_b"), "sig")
    met = keyed.withColumnRenamed("id", "id_a").join(ahead, ["part", "sig"]).where(((F.col("part_b") > F.col("part")) | (F.col("id_a") < F.col("id_b"))) & (F.least("n", "n_b") >= F.greatest("n", "n_b") * least - 1e-9))
    pairs = met.select("id_a", "id_b").distinct()
    of = lambda name: classes.select(F.col("id").alias(f"id_{name}"), F.col("sigs").alias(name))
    scored = pairs.join(of("a"), "id_a").join(of("b"), "id_b").withColumn("similarity", pruned_jaccard(F.col("a"), F.col("b"), least))
    return scored.where(F.col("similarity") >= least).select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "similarity")


def position_bucket(position: Column, bounds: list[int]) -> Column:
    """Number of the range of ``bounds`` (by a tree of comparisons), times ``PIECES``, plus an even piece of it."""

    def tree(low: int, high: int) -> Column:
        if low + 1 == high:
            a, b = bounds[low], bounds[high]
            # decimal: the span of two longs may exceed one
            part = ((position.cast("decimal(38,0)") - F.lit(a)) * PIECES / F.lit(b - a + 1)).cast("int") if b > a else F.lit(0)
            return F.lit(low * PIECES) + F.greatest(F.lit(0), F.least(F.lit(PIECES - 1), part))
        middle = (low + high) // 2
        return F.when(position < F.lit(bounds[middle]), tree(low, middle)).otherwise(tree(middle, high))

    return tree(0, len(bounds) - 1) if len(bounds) > 1 else F.lit(0)


def with_next(rows: DataFrame, position: str, columns: list[str], ties: str) -> DataFrame:
    """``rows`` with next_<column> of the row that follows in descending ``position``; the first follows the last.

    Positions are dealt into at most RANGES * PIECES buckets; the head of each bucket is sent to the one above, too, so
    that no window spans more than a bucket.
    """
    quantiles = rows.agg(F.percentile_approx(position, [k / RANGES for k in range(RANGES + 1)], 20 * RANGES).alias("q")).first().q
    bounds = sorted(set(quantiles or []))
    dealt = rows.withColumn("bucket", position_bucket(F.col(position), bounds).cast("int"))
    heads = dealt.groupBy("bucket").agg(F.max(position).alias("head"))
    # RANGES * PIECES rows at most, so one window over all of them is small
    every = Window.orderBy("bucket")
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    halos = heads.select("head", F.coalesce(F.lead("bucket").over(every), F.first("bucket").over(whole)).alias("also"))
    placed = dealt.join(F.broadcast(halos), dealt[position] == halos["head"], "left").drop("head")
    own = F.struct(F.col("bucket"), F.lit(False).alias("halo"))
    more = F.struct(F.col("also").alias("bucket"), F.lit(True).alias("halo"))
    sent = placed.withColumn("to", F.explode(F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, more)))).drop("bucket", "also").select("*", "to.bucket", "to.halo").drop("to")
    order = Window.partitionBy("bucket").orderBy("halo", F.desc(position), ties)
    found = sent.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return found.where(~F.col("halo")).drop("bucket", "halo")


def fingerprint_with_edit(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_signatures, size_part).

    The edited text has its last third (code points, rounded down) replaced by as many first ones of the next document
    in descending id, or all it has. The likeness of two fingerprints is their exact Jaccard similarity. A null text is empty; a null id comes last; rows of equal id follow each other in
    the order of their text; a lone row follows itself; an empty table gives none.
    """
    rows = docs.select(F.col(row_id).alias("doc_id"), F.coalesce(F.col(row_id), F.lit(-(1 << 63))).cast("long").alias("position"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    rows = with_next(rows.withColumn("sigs", signatures(F.col("body"))), "position", ["body", "sigs"], "body")
    n = F.length("body")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("body", F.lit(1), n - third), F.substring("next_body", F.lit(1), third))
    found = rows.select("doc_id", n.cast("long").alias("n_chars"), "sigs", "next_sigs", edited.alias("edited")).withColumn("edited_sigs", signatures(F.col("edited")))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), written(F.col("sigs")).alias("fingerprint"), written(F.col("edited_sigs")).alias("edited_fingerprint"),
        jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        F.size("sigs").alias("n_signatures"), size_partition(F.size("sigs"), 0.8).alias("size_part"),
    )
