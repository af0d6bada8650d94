"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

For every sample number a word with weight w draws r and c from Gamma(2, 1) and b from the
uniform distribution, all from hashes of the word and the number. With t = floor(ln w / r + b)
the word's value is ln c - r (t - b + 1); the smallest value of a text is its sample (word, t).
Two texts have equal samples with a probability equal to their generalised Jaccard similarity,
the sum of smaller weights over the sum of larger ones. A word's weight is how often it stands.

A text's words are counted where its row is: the partitioning by document that brings text and
neighbour together also serves both aggregations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.llm.common import BLANKS, document_key, whole
from orderlens.session import staged

SAMPLES = 32
UNIT = 2.0 ** -32
PASS = 40.0  # see ``sample``: e**-40 is 4e-18


def _uniforms(hashed: Column) -> tuple[Column, Column]:
    """Two numbers in (0, 1) from the halves of a hash."""
    low = hashed.bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned(hashed, 32)
    return (low + 0.5) * UNIT, (high + 0.5) * UNIT


def sample(word: Column, log_weights: list[Column], room: Column, single: Column,
           number: int) -> list[Column]:
    """Per weight, value and identity of a word's sample in one long, ordered by value; null
    for the null logarithm of no weight, and where the word cannot be the smallest.

    The upper half holds the value (ln c lies in -25 to 4, r (t - b + 1) in 0 to about 80,
    so 2**22 steps a unit fit), the lower half a hash of (word, t).

    Most words are ruled out without a logarithm. With x = u1 u2 and y = u3 u4 from uniform
    numbers, c = -ln x is at least 2 (1 - x) / (1 + x). For weight 1, t is 0 and the value
    ln(c y**(1 - b)); a geometric mean is no less than the harmonic one, so y**(1 - b) is at
    least y / (1 - b + b y). For another weight w, r (t - b + 1) is at most ln w + r, and
    exp(-r) is y. The smallest of a text's values is the logarithm of an exponential draw with
    the text's weight W as its rate: it passes PASS / W with a probability of e**-PASS.
    ``room`` is PASS w / W; ``single`` tells that no weight is above 1.
    """
    u1, u2 = _uniforms(F.xxhash64(word, F.lit(3 * number)))
    u3, u4 = _uniforms(F.xxhash64(word, F.lit(3 * number + 1)))
    beta, _ = _uniforms(F.xxhash64(word, F.lit(3 * number + 2)))
    x, y = u1 * u2, u3 * u4
    power = F.when(single, 1 - beta).otherwise(F.lit(1.0))
    may_win = 2 * (1 - x) * y <= room * ((1 + x) * (power + (1 - power) * y))
    c, r = -F.log(x), -F.log(y)

    def packed(value: Column, t: Column) -> Column:
        steps = F.floor(value * 2.0 ** 22).cast("long")
        return F.call_function("shiftleft", steps, F.lit(32)).bitwiseOR(
            F.xxhash64(word, t).bitwiseAND(F.lit(0xFFFFFFFF)))

    out = []
    for log_weight in log_weights:
        t = F.floor(log_weight / r + beta)
        none = F.lit(0).cast("long")
        out.append(F.when(may_win & log_weight.isNotNull(), F.when(
            log_weight == 0, packed(F.log(c) - r * (none - beta + 1), none)).otherwise(
            packed(F.log(c) - r * (t - beta + 1), t))))
    return out


def signatures(texts: DataFrame, by: list[str], names: list[str],
               samples: int = SAMPLES) -> DataFrame:
    """Arrays of ``samples`` longs under ``names`` for every group of rows (by, _role, _text),
    one per role 0, 1, ...; null for a role without words, and groups without any left out.

    The roles of a group share most words, so a word's row serves all of them. Partitioned by
    some of ``by``, it needs no shuffle.
    """
    roles = range(len(names))
    split = texts.select(*by, "_role", F.split("_text", f"[{BLANKS}]+").alias("_words"))
    # Its size is the text's weight, up to two empty pieces at the ends.
    words = split.select(*by, "_role", F.size("_words").alias("_all"),
                         F.explode("_words").alias("_word"))
    counts = words.where("_word <> ''").select(
        *by, "_role", "_all", F.xxhash64("_word").alias("_word")).groupBy(*by, "_word").agg(
        *[F.sum((F.col("_role") == i).cast("long")).alias(f"_n{i}") for i in roles],
        F.min("_all").alias("_all"))
    most = F.greatest(*[F.col(f"_n{i}") for i in roles])
    weighted = counts.select(
        *by, "_word", (PASS * most / F.greatest(F.col("_all") - 2, F.lit(1))).alias("_room"),
        (most == 1).alias("_single"),
        *[F.log(F.col(f"_n{i}").cast("double")).alias(f"_log{i}") for i in roles])
    drawn = [sample(F.col("_word"), [F.col(f"_log{i}") for i in roles], F.col("_room"),
                    F.col("_single"), k) for k in range(samples)]
    least = weighted.groupBy(*by).agg(*[
        F.min(values[i]).alias(f"_s{i}_{k}") for k, values in enumerate(drawn) for i in roles])
    return least.select(*by, *[
        F.when(F.col(f"_s{i}_0").isNotNull(), F.array(*[f"_s{i}_{k}" for k in range(samples)]))
        .alias(name) for i, name in enumerate(names)])


def likeness(left: Column, right: Column) -> Column:
    """Share of equal samples; two texts without words are alike, one alone is not."""
    same = F.size(F.filter(F.zip_with(left, right, lambda a, b: a == b), lambda x: x))
    return F.when(left.isNull() & right.isNull(), 1.0).when(
        left.isNull() | right.isNull(), 0.0).otherwise(same / F.size(left))


def fingerprint(sig: Column) -> Column:
    """Hash of the samples as hex; the empty string for a text without words."""
    parts = F.transform(sig, lambda s: F.lpad(F.hex(s.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.coalesce(F.lower(F.array_join(parts, "")), F.lit(""))


def followers(keys: DataFrame) -> DataFrame:
    """For unique keys (_doc, _hash): the next one by descending _doc, then _hash, after the
    last the first, as _next_doc and _next_hash.

    Keys are ranged over partitions; windows run inside them, and only one row per partition
    is ordered as a whole.
    """
    order = [F.col("_doc").desc(), F.col("_hash")]
    key = F.struct("_doc", "_hash")
    ranged = staged(keys.repartitionByRange(*order).select(
        "*", F.spark_partition_id().alias("_part")))
    inside = W.partitionBy("_part").orderBy(*order)
    led = ranged.select("*", F.lead(key).over(inside).alias("_next"))
    first = ranged.withColumn("_f", F.row_number().over(inside)).where("_f = 1").select(
        "_part", key.alias("_first"))
    around = first.withColumn("_after", F.lead("_first").over(W.orderBy("_part"))).withColumn(
        "_top", F.first("_first").over(W.orderBy("_part")))
    edges = around.select("_part", F.coalesce("_after", "_top").alias("_edge"))
    out = led.join(F.broadcast(edges), "_part").withColumn(
        "_next", F.coalesce("_next", "_edge"))
    return out.select(*keys.columns, F.col("_next._doc").alias("_next_doc"),
                      F.col("_next._hash").alias("_next_hash"))


def with_edits(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct documents (_doc, _hash) with their size in characters, their text, the edited
    text and the key of the next document.

    The last third of the characters (rounded down) gives way to as many first characters of
    the next document. Only that prefix travels to the document, not the next text; the one
    shuffle of the texts serves both sides.
    """
    key = ["_doc", "_hash"]
    texts = docs.select(*document_key(doc, text), whole(text).alias("_text"))
    rows = texts.withColumn("_copy", F.row_number().over(
        W.partitionBy(*key).orderBy("_doc"))).where("_copy = 1").drop("_copy")
    keys = docs.select(*document_key(doc, text), F.char_length(whole(text)).alias("_size")) \
        .groupBy(*key).agg(F.max("_size").alias("_size"))
    links = staged(followers(keys))
    asked = links.select(F.col("_next_doc").alias("_doc"), F.col("_next_hash").alias("_hash"),
                         F.struct(*key).alias("_for"), F.expr("_size div 3").alias("_need"))
    prefixes = rows.join(asked, key).select(
        "_for.*", F.substring("_text", F.lit(1), F.col("_need").cast("int")).alias("_prefix"))
    left = F.col("_size") - F.expr("_size div 3")
    return rows.join(links, key).join(prefixes, key).withColumn("_edited", F.concat(
        F.substring("_text", F.lit(1), left.cast("int")), "_prefix"))


def compare(docs: DataFrame, doc: str = "doc_id", text: str = "text",
            samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A null text counts as empty, a null id as the smallest. Documents with one id follow each
    other by a hash of their text; repeated rows stay, but are one document in the order; a
    single document follows itself. No rows give no rows.
    """
    key = ["_doc", "_hash"]
    edits = with_edits(docs, doc, text)
    both = edits.select(*key, F.explode(F.array(
        F.struct(F.lit(0).alias("_role"), F.col("_text").alias("_text")),
        F.struct(F.lit(1).alias("_role"), F.col("_edited").alias("_text")))).alias("_r"))
    pairs = signatures(both.select(*key, "_r.*"), key, ["_own", "_other"], samples)
    facts = edits.select(*key, "_next_doc", "_next_hash",
                         F.col("_size").cast("long").alias("n_chars"),
                         F.sha2("_edited", 256).alias("edited_sha256"))
    known = staged(facts.join(pairs, key, "left"))
    following = known.select(F.col("_doc").alias("_next_doc"), F.col("_hash").alias("_next_hash"),
                             F.col("_own").alias("_following"))
    compared = known.join(following, ["_next_doc", "_next_hash"]).select(
        *key, "n_chars", "edited_sha256", fingerprint(F.col("_own")).alias("fingerprint"),
        fingerprint(F.col("_other")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_other")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_following")).alias("near_next"))
    named = docs.select(F.col(doc).alias("doc_id"), *document_key(doc, text))
    return named.join(compared, key, "left").drop(*key)
