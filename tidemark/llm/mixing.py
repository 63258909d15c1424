"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, fresh, whole_text

#: A draw with a larger mean is the sum of independent draws with at most this mean.
LARGEST_MEAN = 32.0
#: Steps of the distribution function; beyond them less than 2**-53 is left at LARGEST_MEAN.
STEPS = 128


def uniform(seed: int, key: Column, part: Column) -> Column:
    """A number in [0, 1) from 52 bits of a seeded hash of the row and the part of its draw."""
    text = F.concat_ws(":", F.lit(str(seed)), key, part.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def distribution(mean: Column) -> Column:
    """P(N <= n) for n = 0, 1, ..., STEPS - 1 of a Poisson variable, as an array."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), F.array(first).alias("sums"))

    def step(acc, n):
        p = acc["p"] * mean / n.cast("double")
        return F.struct(p.alias("p"), F.concat(acc["sums"], F.array(F.element_at(acc["sums"], -1) + p)).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS - 1)), start, step, lambda acc: acc["sums"])


def repetition_rates(
    docs: DataFrame, weights: dict[str, float], rest: float, source: str, text: str, size: int | None
) -> DataFrame:
    """One row per weighted source and one for all others: the mean number of copies of a document.

    A source's rate is its share of the output, in characters, over what it has. There are at most
    `len(weights) + 1` rows whatever the corpus holds, so the result may be broadcast.
    """
    if rest < 0 or any(not w >= 0 or math.isinf(w) for w in weights.values()):
        raise ValueError("weights are finite and not negative")
    total = sum(weights.values()) + rest
    if not total > 0:
        raise ValueError("no weight is positive")
    group = mixing_group(weights, source)
    had = docs.select(group.alias("grp"), F.length(whole_text(col(text))).cast("long").alias("chars"))
    had = had.groupBy("grp").agg(F.sum("chars").alias("chars"))
    shares = docs.sparkSession.createDataFrame(
        [(f"={s}", w / total) for s, w in weights.items()] + [("", rest / total)], "grp string, share double"
    )
    # The window sees no more rows than there are weights.
    target = F.lit(size).cast("double") if size is not None else F.sum("chars").over(Window.partitionBy(F.lit(1))).cast("double")
    rates = had.join(F.broadcast(shares), "grp").withColumn("target", target)
    rate = F.when(F.col("chars") > 0, F.col("share") * F.col("target") / F.col("chars")).otherwise(F.lit(0.0))
    rates = rates.select("grp", rate.alias("rate"))
    parts = F.greatest(F.ceil(F.col("rate") / LARGEST_MEAN), F.lit(1)).cast("int")
    rates = rates.withColumn("parts", parts)
    return rates.withColumn("sums", distribution(F.col("rate") / F.col("parts")))


def mixing_group(weights: dict[str, float], source: str) -> Column:
    """'=' and the source where it has a weight of its own, which '' may have too, else ''. Null sources are in ''."""
    name = col(source).cast("string")
    return F.when(name.isin(list(weights)), F.concat(F.lit("="), name)).otherwise(F.lit("")) if weights else F.lit("")


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float],
    rest: float = 0.0,
    seed: int = 0,
    size: int | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    copy: str = "copy",
    order: str = "mix_key",
) -> DataFrame:
    """Replicate documents so that sources have their target share of the characters, and shuffle.

    The number of copies of a document is a Poisson draw with its source's mean repetition rate. The
    draw inverts the distribution function at a uniform number that is a hash of `seed` and
    `doc_id`: how many steps of the function lie at or below it. It does not depend on how the table
    is partitioned, so a task that is run again draws the same. `size` is the target in characters,
    that of `docs` by default. Sources without a weight, and null ones, share `rest`; a source with
    weight 0 goes. The share of a weighted source without rows or characters stays unused: the output is smaller by it.

    Each copy is dealt to a partition and sorted there by a hash of seed, id and copy: the order of the
    output is a random one. A hot source is spread like any other, as the key differs from copy to copy.

    Equal ids draw equal counts. A null id draws by a hash of the text. Null and empty texts have no
    characters and are copied like others of their source; a source without any characters gives no
    copies. An empty table gives an empty one. All columns stay; `copy` (from 1) and `order` are added
    and replace columns of these names.
    """
    rates = repetition_rates(docs, weights, rest, source, text, size)
    docs = docs.select(*(col(c).alias(c) for c in docs.columns if c.lower() not in (copy.lower(), order.lower())))
    group, rate, parts, sums = (fresh(docs, n) for n in ("td_group", "td_rate", "td_parts", "td_sums"))
    named = rates.select(*(F.col(a).alias(b) for a, b in zip(("grp", "parts", "sums"), (group, parts, sums), strict=True)))
    key = F.coalesce(col(doc_id).cast("string"), F.md5(whole_text(col(text))))
    drawn = docs.withColumn(group, mixing_group(weights, source)).join(F.broadcast(named), group)
    draws = F.transform(F.sequence(F.lit(0), F.col(parts) - 1), lambda part: uniform(seed, key, part))
    count = F.aggregate(draws, F.lit(0), lambda acc, u: acc + F.size(F.filter(F.col(sums), lambda p: p <= u)))
    n = fresh(docs, "td_copies")
    drawn = drawn.withColumn(n, count).filter(F.col(n) > 0)
    copies = drawn.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n))))
    mixed = copies.withColumn(order, F.md5(F.concat_ws(":", F.lit(f"{seed}+"), key, F.col(copy).cast("string"))))
    mixed = mixed.select(*(col(c) for c in docs.columns), F.col(copy), F.col(order))
    return mixed.repartition(order).sortWithinPartitions(order)
