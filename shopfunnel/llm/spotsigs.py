"""Document fingerprints from spot signatures.

Function words are anchors; the chain of content words after one, function words skipped, is a
spot signature. A document's fingerprint is the set of its signatures' hashes, and the likeness of
two fingerprints is their Jaccard similarity. Near duplicates are searched for among sets of
lengths that allow the similarity only. All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfunnel.llm.common import saved

#: Function words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his in is it its not of on or she that the their they "
    "this to was we were what which who will with you "
    "auf aus bei das dem den der des die ein eine einen einer für ist mit nicht sich sie und von zu zum "
    "au aux avec ce ces dans de des du elle en est et il la le les pas pour que qui sa se ses sur un une "
    "al con del el es esta este las lo los mi no para por su una y"
).split()
#: Words of a chain, and content words without an anchor after which the next begins one anyway.
CHAIN, GAP = 3, 8
#: Parts the order of ids is cut into.
_PARTS = 256


def _any_of(words: list[str]) -> str:
    """Pattern of the words, those of one first letter tried together."""
    by_letter: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        by_letter.setdefault(word[0], []).append(word[1:])
    return "|".join(f"{letter}(?:{'|'.join(sorted(ends, reverse=True))})" for letter, ends in by_letter.items())


def _marked(text: Column) -> Column:
    """The text's content words, lower-cased, with a mark at each that follows an anchor."""
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]++", " "), F.lit(" "))
    anchored = F.regexp_replace(words, f" (?:{_any_of(ANCHORS)})(?= )", " ·")
    attached = F.regexp_replace(F.regexp_replace(anchored, " ++", " "), "(?:· )++", "·")
    return F.regexp_replace(attached, f" ((?:[^ ·][^ ]*+ ){{{GAP}}}+)(?=[^ ·])", " $1·")


def signatures(text: Column) -> Column:
    """Sorted distinct hashes of a text's spot signatures.

    Stretches without anchors get one every few words. A text with too few words for that is one
    signature; a null or empty text has none.
    """
    chains = F.regexp_extract_all(_marked(text), F.lit(f"·(?=([^ ]+(?: [^ ]+){{0,{CHAIN - 1}}}))"), 1)
    spots = F.array_sort(F.array_distinct(F.transform(chains, lambda c: F.hash(c))))
    # a variable of a lambda is worked out once, an expression in two branches twice
    any_spots = F.transform(F.array(spots), lambda found: F.when(F.size(found) == 0, F.array(F.hash(text))).otherwise(found))
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.array().cast("array<int>")).otherwise(any_spots[0])


def to_string(spots: Column) -> Column:
    """Signatures as text, eight hexadecimal digits each."""
    digits = F.transform(spots, lambda s: F.lpad(F.hex(s.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.array_join(digits, "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sorted sets; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def with_next(docs: DataFrame, id_col: str, columns: list[str], derived: dict[str, Column]) -> DataFrame:
    """``docs`` with ``derived`` columns and a struct ``next`` of ``columns`` of the row after each by descending id.

    After the last row comes the first; rows of one id follow each other by text, null ids come
    last. The order is cut into parts at sampled ids; each part also gets the first row of the
    part after it, so that no row has to look beyond its own part. Columns are derived behind that,
    once a row.
    """
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    ids = docs.select(order.alias("k"))
    shares = [k / _PARTS for k in range(1, _PARTS)]
    cuts = ids.agg(F.percentile_approx("k", shares, 10_000).alias("cuts")).first()["cuts"] or []
    part = F.lit(0)
    for cut in sorted(set(cuts)):
        part = part + (F.col("k") > F.lit(cut)).cast("int")
    firsts = ids.select("k", part.alias("part")).groupBy("part").agg(F.max("k").alias("k")).collect()
    firsts = sorted(((r["part"], r["k"]) for r in firsts), reverse=True)
    after = {firsts[i][0]: firsts[(i + 1) % len(firsts)][1] for i in range(len(firsts))}
    spark = docs.sparkSession
    lent = spark.createDataFrame([(k, p) for p, k in after.items()] or [], "k long, to_part int")

    keyed = docs.withColumn("k", order)
    own = keyed.withColumn("part", part).withColumn("ghost", F.lit(False))
    # the ids are at most as many as the parts
    ghosts = keyed.join(F.broadcast(lent), "k").withColumnRenamed("to_part", "part").withColumn("ghost", F.lit(True))
    line = Window.partitionBy("part").orderBy("ghost", F.desc("k"), "text")
    both = own.unionByName(ghosts).withColumns(derived).withColumn("next", F.lead(F.struct(*columns)).over(line))
    return both.filter(~F.col("ghost")).drop("k", "part", "ghost")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of the text with its second half taken from the next one.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. A null text is empty and has an empty fingerprint. Ids are integers; null ones come
    last in the order. Repeated rows are kept. A single row is its own next. An empty table gives an
    empty result. Other columns are not read.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    paired = with_next(read, "doc_id", ["text", "spots"], {"spots": signatures(F.col("text"))})
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next.text", half))
    paired = paired.withColumn("edited", edited).withColumn("edited_spots", signatures(F.col("edited")))
    return paired.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        to_string(F.col("spots")).alias("fingerprint"),
        to_string(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next.spots")).alias("near_next"),
    )


def near_pairs(
    docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Near duplicates: pairs of classes, and the class of each row.

    The first table has ``a, b, likeness`` for classes of equal fingerprints whose likeness is at
    least ``similarity``; the second ``doc_id, spot_class``. Texts without signatures are left out.
    Sets are partitioned by length, so that partners lie in one partition or in neighbouring ones.
    Of a set only the first signatures are looked up, those of which a partner must share one; pairs
    whose lengths or places rule the similarity out are pruned before any set is compared.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), signatures(F.col(text_col)).alias("spots"))
    rows = saved(read.filter("size(spots) > 0").withColumn("spot_class", F.xxhash64("spots")), "spots")
    sets = saved(rows.groupBy("spot_class").agg(F.first("spots").alias("spots")), "spot-sets")
    size, t = F.size("spots"), F.lit(similarity)
    first = F.slice("spots", 1, (size - F.ceil(t * size - 1e-9) + 1).cast("int"))
    partition = F.floor(F.log(size) / F.log(F.lit(1.0001) / t))
    heads = sets.select("spot_class", size.alias("size"), partition.alias("lengths"), F.posexplode(first).alias("pos", "spot"))
    near = F.explode(F.array("lengths", F.col("lengths") - 1))
    left = heads.select(F.col("spot_class").alias("a"), F.col("size").alias("size_a"), F.col("pos").alias("pos_a"), "lengths", "spot")
    right = heads.select(
        F.col("spot_class").alias("b"), F.col("size").alias("size_b"), F.col("pos").alias("pos_b"),
        F.col("lengths").alias("own"), near.alias("near"), "spot",
    ).withColumnRenamed("near", "lengths")
    shortest, longest = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    rest = F.least(F.col("size_a") - F.col("pos_a"), F.col("size_b") - F.col("pos_b"))
    met = left.join(right, ["lengths", "spot"]).filter(
        (shortest >= t * longest - 1e-9)
        & (rest * (1 + t) >= t * (F.col("size_a") + F.col("size_b")) - 1e-9)
        & ((F.col("own") > F.col("lengths")) | (F.col("a") < F.col("b")))
    )
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for x in "ab":
        pairs = pairs.join(sets.select(F.col("spot_class").alias(x), F.col("spots").alias(f"spots_{x}")), x)
    found = pairs.select("a", "b", likeness(F.col("spots_a"), F.col("spots_b")).alias("likeness"))
    return found.filter(F.col("likeness") >= t), rows.select("doc_id", "spot_class")
