"""Mix sources to target weights: rake token weights to marginals, then sample documents.

Tokens are summed into the cells of source, language and topic. Iterative proportional fitting multiplies
the weight of each cell in turn so that the weighted tokens of every source, then every language, then
every topic take their target shares, until no share is off by more than the tolerance. Targets that
contradict each other are left when rounds no longer bring them nearer, or after ``rounds`` rounds; ``fit_error`` is the largest relative error that
remains. A document's probability is
proportional to the weight of its cell, at most 1, at a level at which the expected tokens meet the budget.
It is drawn when a hash of its id, as a number in [0, 1), is below its probability, so a repeated task draws
the same documents. The cap makes the drawn shares fall short of the targets wherever a cell has fewer
tokens than its share of the budget.

``copies`` has no cap: a document's expected copies are its weight times ``rate * all tokens / weighted tokens``,
of which the whole part is always drawn and the rest by the same hash. Expected tokens of the copies take the
target shares and the budget exactly.

Default targets: sources in proportion to a power of their tokens (a power below 1 flattens a hot source);
languages and topics from given tables, scaled to what is present; a value not in the table takes
``other``. The topic of a document is the length class of its mean word by default, as the test
tables have no topic column; pass a column to use another.

Defined cases: null source, language or topic is a value of its own; a null or empty text has 0 tokens,
takes part in no sum, and is kept with the probability of its cell (that of an absent cell is 0); rows
with one id share its draw; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.plans.durable import durable

LANGUAGE_TARGETS = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
TOPIC_TARGETS = {"short": 0.3, "medium": 0.4, "long": 0.3}
OTHER = 0.05
SOURCE_POWER = 0.5
RATE = 0.6
ROUNDS = 60
TOLERANCE = 1e-10
# Rounds that leave more than this part of the error show that the targets contradict each other.
STALLED = 0.999
SEED = "mix-1"
MARGINS = ("source", "lang", "topic")


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def word_length_topic(text: Column, n_tokens: Column) -> Column:
    """Mean characters per word, blanks included: below 5.5 short, from 6.5 long."""
    mean = F.length(F.coalesce(text, F.lit(""))) / F.greatest(n_tokens, F.lit(1))
    return F.when(mean < 5.5, "short").when(mean < 6.5, "medium").otherwise("long")


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) from 52 bits of a hash of the key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def share_column(name: str, table: Mapping[str, float], other: float) -> Column:
    share = F.lit(other)
    for value, target in table.items():
        share = F.when(F.col(name) == value, F.lit(float(target))).otherwise(share)
    return share


def targets(
    cells: DataFrame, languages: Mapping[str, float], topics: Mapping[str, float], other: float, power: float
) -> dict[str, DataFrame]:
    """Per margin: its values and their target tokens, which add up to all tokens."""
    wanted = {
        "source": F.pow(F.col("tokens").cast("double"), F.lit(power)),
        "lang": share_column("lang", languages, other),
        "topic": share_column("topic", topics, other),
    }
    out = {}
    for margin, share in wanted.items():
        present = cells.groupBy(margin).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
        shares = present.withColumn("raw", share)
        whole = F.broadcast(shares.agg(F.sum("raw").alias("whole"), F.sum("tokens").alias("all")))  # one row
        out[margin] = shares.join(whole).select(
            F.col(margin).alias(f"{margin}_key"), (F.col("raw") / F.col("whole") * F.col("all")).alias("target")
        )
    return out


def rake(
    cells: DataFrame, wanted: Mapping[str, DataFrame], rounds: int, tolerance: float, together: int = 3
) -> tuple[DataFrame, float]:
    """Add ``weight`` to the cells with tokens so that the weighted tokens take the target shares, and tell the error left.

    The sums of a margin come from a window over the cells, which are few: one row per source,
    language and topic, whatever the number of documents. ``together`` rounds make one plan.
    """
    fitted = cells.where("tokens > 0").withColumn("weight", F.lit(1.0))
    for margin, shares in wanted.items():
        shares = shares.withColumnRenamed("target", f"{margin}_target")
        fitted = fitted.join(shares, F.col(margin).eqNullSafe(F.col(f"{margin}_key"))).drop(f"{margin}_key")
    fitted, worst = durable(fitted), float("inf")
    for start in range(0, rounds, together):
        for _ in range(min(together, rounds - start)):
            for margin in wanted:
                now = F.sum(F.col("weight") * F.col("tokens")).over(Window.partitionBy(margin))
                fitted = fitted.withColumn("factor", F.col(f"{margin}_target") / now).withColumn(
                    "weight", F.col("weight") * F.col("factor")
                )
        # The weights settle when the last step of a round leaves the sums of the other margins alone.
        off = [
            F.abs(F.sum(F.col("weight") * F.col("tokens")).over(Window.partitionBy(m)) / F.col(f"{m}_target") - 1)
            for m in wanted
        ]
        fitted = durable(fitted.withColumn("off", F.greatest(*off)))
        before, worst = worst, fitted.agg(F.max("off")).first()[0] or 0.0
        if worst <= tolerance or worst > STALLED * before:
            break
    return fitted.select(*cells.columns, "weight"), worst


def level(fitted: DataFrame, budget: float) -> float:
    """The factor at which the expected tokens, with no probability above 1, come to the budget.

    One pass finds what is capped at the present factor and raises the factor for the rest; it ends
    when no more cells are capped.
    """
    factor = 0.0
    start = fitted.agg(F.sum(F.col("weight") * F.col("tokens"))).first()[0]
    if start:
        factor = budget / start
    while start:
        capped = F.col("weight") * factor >= 1
        full, rest = fitted.agg(
            F.coalesce(F.sum(F.when(capped, F.col("tokens"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight") * F.col("tokens"))), F.lit(0.0)),
        ).first()
        new = (budget - full) / rest if rest > 0 and budget > full else factor
        if abs(new - factor) <= 1e-12 * factor:
            break
        factor = new
    return factor


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topic: Column | None = None,
    languages: Mapping[str, float] = LANGUAGE_TARGETS,
    topics: Mapping[str, float] = TOPIC_TARGETS,
    other: float = OTHER,
    power: float = SOURCE_POWER,
    rate: float = RATE,
    rounds: int = ROUNDS,
    tolerance: float = TOLERANCE,
    seed: str = SEED,
) -> DataFrame:
    """All columns of ``docs`` in ``doc``, with ``n_tokens, weight, probability, drawn, expected_copies, copies, fit_error``.

    ``docs`` is read twice: for the cells, and for the result.
    """
    own = [F.col(source).alias("source"), F.col(lang).alias("lang"), F.col(text).alias("__text")]
    counted = docs.select(
        F.struct(*docs.columns).alias("doc"), F.col(key).alias("__key"), *own, tokens(F.col(text)).alias("n_tokens")
    ).withColumn("topic", topic if topic is not None else word_length_topic(F.col("__text"), F.col("n_tokens")))
    cells = durable(counted.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")))
    fitted, error = rake(cells, targets(cells, languages, topics, other, power), rounds, tolerance)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    factor = level(fitted, rate * total)
    whole = fitted.agg(F.sum(F.col("weight") * F.col("tokens"))).first()[0]
    uncapped = rate * total / whole if whole else 0.0
    weights = fitted.select(*[F.col(m).alias(f"{m}_key") for m in MARGINS], "weight")
    same_cell = [F.col(m).eqNullSafe(F.col(f"{m}_key")) for m in MARGINS]
    # Many rows share a cell, and the cells are few against the documents; adaptive execution
    # broadcasts them when they are small and splits hot cells when they are not.
    joined = counted.join(weights, same_cell, "left")
    probability = F.least(F.lit(1.0), F.coalesce(F.col("weight"), F.lit(0.0)) * F.lit(factor))
    weight, draw = F.coalesce("weight", F.lit(0.0)), uniform(F.col(f"doc.{key}"), seed)
    drawn = joined.select(
        "doc", "source", "lang", "topic", "n_tokens", weight.alias("weight"), probability.alias("probability"),
        (weight * F.lit(uncapped)).alias("expected_copies"), F.lit(error).alias("fit_error"),
    ).withColumn("drawn", draw < F.col("probability"))
    sure = F.floor("expected_copies").cast("int")
    return drawn.withColumn("copies", sure + (draw < F.col("expected_copies") - sure).cast("int"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The documents of ``mix``, each as many times as its ``copies``."""
    return mixed.where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
