"""Best catalogue entry of each free-typed code among those that score at least a threshold, as joins.

The score is that of ``matching``: on the sorted distinct tokens of both texts, with ``I`` the shared tokens, it is 100 when ``I`` is all of
one side, else the best of ratio(I, a), ratio(I, b) and ratio(I+A, I+B). Scores are rounded, so a raw score of half a point less counts.

1. *Shared tokens* decide the first two rules. For ratio(I, a) to reach the threshold ``I`` must hold a known share of a's length,
   so among a's rarest tokens, taken until what is left would not do, one is shared; taken a little further, two are.
   Texts are joined on such pairs of tokens (single tokens where one alone may do), once from the rare tokens of codes to all of
   entries, once the other way round. Everything here is built-in functions.
2. *Near texts* may share no token. Their lengths lie in a band and they hold mostly the same characters. Both sides
   are cut into blocks of like length; blocks whose lengths are compatible meet by a shuffle, and one matrix
   product per chunk counts the characters that each pair has in common. Subsequences are computed for pairs whose bound still
   exceeds the code's best score, highest bound first. Codes that a shared-token rule gave 100 have nothing to gain and stay out.

Nothing is collected, and only the best entry per code and task leaves a task.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.operators.matching import token_text
from faultline.plans.durable import durable
from faultline.plans.sizing import measured_side

BLOCK = 8_192
LENGTH_STEP = 1.15  # texts of a class differ in length by this factor at most
CHUNK = 256  # codes per matrix product
PAIRS = 8_192  # subsequences computed at a time
EXACT = 100.0
FOUND = "text string, score double, pos long, entry string"


def least_raw(threshold: float) -> float:
    """Scores from here on may round to the threshold."""
    return threshold - 0.5


def _band(threshold: float) -> float:
    """Share of the longer text's length that the shorter one, or the shared tokens of a text, must have."""
    raw = least_raw(threshold)
    return raw / (200 - raw)


def _by_rarity(texts: DataFrame, frequency: DataFrame) -> DataFrame:
    """``texts`` with ``tokens``, rarest in the catalogue first."""
    tokens = texts.select("text", F.explode(F.split("text", " ")).alias("token"))
    counted = tokens.join(measured_side(frequency), "token", "left").select(
        "text", F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token").alias("t")
    )
    ordered = counted.groupBy("text").agg(F.sort_array(F.collect_list("t"))["token"].alias("tokens"))
    return texts.join(ordered, "text")


def _pairs(tokens: Column) -> Column:
    """All pairs of tokens, each in one order."""
    def behind(t: Column, i: Column) -> Column:
        others = F.slice(tokens, i + 2, F.greatest(F.size(tokens) - i - 1, F.lit(0)))
        return F.transform(others, lambda u: F.concat_ws(" ", F.least(t, u), F.greatest(t, u)))

    return F.flatten(F.transform(tokens, behind))


def with_keys(texts: DataFrame, threshold: float) -> DataFrame:
    """Texts with ``every`` key, and as ``probes`` those of which any text that shares enough tokens has one: pairs of rare
    tokens if two must be shared, else single ones."""
    weights = F.transform("tokens", lambda t: F.length(t) + 1)
    # Tokens of this weight may be missing from the shared ones; the margin covers rounding.
    slack = F.aggregate("weights", F.lit(-1), lambda a, w: a + w) * (1 - _band(threshold)) + 1e-6
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("top"), F.lit(0).alias("place"), F.lit(0).alias("one"), F.lit(0).alias("two"))

    def step(a: Column, w: Column) -> Column:
        total, top, place = a["sum"] + w, F.greatest(a["top"], w), a["place"] + 1
        one = F.when((a["one"] == 0) & (total > F.col("slack")), place).otherwise(a["one"])
        two = F.when((a["two"] == 0) & (total - top > F.col("slack")), place).otherwise(a["two"])
        fields = (total.alias("sum"), top.alias("top"), place.alias("place"), one.alias("one"), two.alias("two"))
        return F.struct(*fields)

    sized = texts.withColumn("weights", weights).withColumn("slack", slack).withColumn("cut", F.aggregate("weights", start, step))
    one = F.when(F.col("cut.one") > 0, F.col("cut.one")).otherwise(F.size("tokens"))
    rare = sized.withColumn("rare", F.slice("tokens", F.lit(1), F.when(F.col("cut.two") > 0, F.col("cut.two")).otherwise(one)))
    keyed = rare.withColumn("probes", F.when(F.col("cut.two") > 0, _pairs(F.col("rare"))).otherwise(F.col("rare")))
    keyed = keyed.withColumn("every", F.concat("tokens", _pairs(F.col("tokens"))))
    return keyed.drop("weights", "slack", "cut", "rare")


def _shared(codes: DataFrame, entries: DataFrame, threshold: float) -> DataFrame:
    """``text, score, pos, entry``: the best entry of each code by the rules on shared tokens."""
    own, other = F.split("text", " "), F.split("of", " ")
    both = F.array_intersect(own, other)
    inner = F.aggregate(both, F.lit(-1), lambda a, t: a + F.length(t) + 1)
    shorter = F.least(F.length("text"), F.length("of"))
    whole = F.size(both) == F.least(F.size(own), F.size(other))
    score = F.when(F.size(both) == 0, 0.0).when(whole, EXACT).otherwise(200.0 * inner / (inner + shorter))

    codes, entries = with_keys(codes, threshold), with_keys(entries, threshold).withColumnRenamed("text", "of")

    def marked(probing: str, keys: str) -> Column:
        return F.transform(keys, lambda k: F.concat(F.lit(probing), k))

    # A probe of one side meets all keys of the other; the mark says whose probe it is.
    left = codes.select("text", F.explode(F.concat(marked("<", "probes"), marked(">", "every"))).alias("key"))
    right = entries.select("of", "pos", "entry", F.explode(F.concat(marked("<", "every"), marked(">", "probes"))).alias("key"))
    scored = left.join(right, "key").withColumn("score", score).where(F.col("score") >= least_raw(threshold))
    return _best(scored)


def _best(scored: DataFrame) -> DataFrame:
    best = F.max(F.struct("score", (-F.col("pos")).alias("order"), "entry"))
    found = scored.groupBy("text").agg(best.alias("b"))
    return found.select("text", "b.score", (-F.col("b.order")).alias("pos"), "b.entry")


def levels(texts: list[str], places: dict[tuple[str, int], int]) -> np.ndarray:
    """A row per text with a 1 for each character and each time it stands there; products count common characters."""
    out = np.zeros((len(texts), max(len(places), 1)), np.float32)
    for i, text in enumerate(texts):
        held = [places[c, v] for c, n in Counter(text).items() for v in range(n) if (c, v) in places]
        out[i, held] = 1
    return out


def pair_lcs(left: list[str], right: list[str]) -> np.ndarray:
    """Longest common subsequence of each pair, row by row over all pairs at once."""
    shapes = [max(map(len, side), default=0) for side in (left, right)]
    chars = [
        np.frombuffer("".join(t.ljust(w, pad) for t in side).encode("utf-32-le"), np.uint32).reshape(len(side), w)
        for side, w, pad in zip((left, right), shapes, "\0\1", strict=True)
    ]
    row = np.zeros((len(left), shapes[1] + 1), np.int32)
    for i in range(shapes[0]):
        step = row[:, :-1] + (chars[1] == chars[0][:, i : i + 1])
        row[:, 1:] = np.maximum.accumulate(np.maximum(step, row[:, 1:]), axis=1)
    return row[:, -1]


def full_ratio(left: list[str], right: list[str]) -> np.ndarray:
    """ratio(I+A, I+B) of each pair: the shared tokens lead both sides, so only the rest needs a subsequence."""
    inner, rests = np.zeros(len(left)), ([], [])
    for k, (a, b) in enumerate(zip(left, right, strict=True)):
        own, other = a.split(" "), b.split(" ")
        both = set(own) & set(other)
        inner[k] = sum(map(len, both)) + len(both)
        for rest, tokens in zip(rests, (own, other), strict=True):
            rest.append(" ".join(t for t in tokens if t not in both))
    lengths = np.array([len(a) + len(b) for a, b in zip(left, right, strict=True)])
    # Without a rest there is no blank behind the shared tokens.
    empty = np.array([not a or not b for a, b in zip(*rests, strict=True)])
    return 200.0 * (inner - (empty & (inner > 0)) + pair_lcs(*rests)) / lengths


def best_of_block(codes: list[str], floor: np.ndarray, entries: list[str], pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each code the entry (-1 for none) of the highest ratio from ``floor`` on, the first of equal ones, and its score."""
    best, score = np.full(len(codes), -1), floor.astype(float).copy()
    # Characters of entries only cannot be shared.
    most: Counter[str] = Counter()
    for text in entries:
        most |= Counter(text)
    places = {(c, v): i for i, (c, v) in enumerate((c, v) for c, n in sorted(most.items()) for v in range(n))}
    theirs, lengths = levels(entries, places), np.array([len(t) for t in entries])
    for start in range(0, len(codes), CHUNK):
        part = codes[start : start + CHUNK]
        own = np.array([len(t) for t in part])
        bound = 200.0 * (levels(part, places) @ theirs.T) / (own[:, None] + lengths)
        row, column = np.nonzero(bound >= score[start : start + CHUNK, None] - 1e-3)
        order = np.argsort(-bound[row, column], kind="stable")
        row, column = row[order] + start, column[order]
        bounds = bound[row - start, column].astype(float) + 1e-3
        while len(row):
            now = slice(0, PAIRS)
            found = full_ratio([codes[i] for i in row[now]], [entries[j] for j in column[now]])
            # The last write of a code stands: lower scores first, then later entries.
            better = np.lexsort((-pos[column[now]], found))
            for k in better[found[better] >= score[row[now]][better]].tolist():
                i, j = int(row[k]), int(column[k])
                if found[k] > score[i] or best[i] < 0 or pos[j] < pos[best[i]]:
                    best[i], score[i] = j, found[k]
            row, column, bounds = row[PAIRS:], column[PAIRS:], bounds[PAIRS:]
            alive = bounds >= score[row]
            row, column, bounds = row[alive], column[alive], bounds[alive]
    return best, score


def _meet(codes: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    names = [c.split()[0] for c in FOUND.split(", ")]
    if codes.empty or entries.empty:
        return pd.DataFrame({n: [] for n in names})
    pos = entries["pos"].to_numpy()
    best, score = best_of_block(codes["text"].tolist(), codes["floor"].to_numpy(), entries["of"].tolist(), pos)
    hit = np.flatnonzero(best >= 0)
    rows = entries.iloc[best[hit]]
    columns = (codes["text"].to_numpy()[hit], score[hit], rows["pos"].to_numpy(), rows["entry"].to_numpy())
    return pd.DataFrame(dict(zip(names, columns, strict=True)))


def _length_class(length: Column) -> Column:
    return F.floor(F.log(length) / F.log(F.lit(LENGTH_STEP))).cast("int")


def _near(codes: DataFrame, entries: DataFrame, threshold: float) -> DataFrame:
    """The best entry of each code of ``text, floor`` by common characters and subsequences."""
    sides, sizes = [], []
    for texts in (codes, entries):
        side = texts.withColumn("length", F.length("text")).withColumn("cls", _length_class(F.col("length")))
        sides.append(side)
        size = side.groupBy("cls").agg(F.min("length").alias("short"), F.max("length").alias("long"), F.count("*").alias("n"))
        sizes.append(size.select("cls", "short", "long", F.ceil(F.col("n") / BLOCK).alias("parts")))
    band = _band(threshold) - 1e-9
    other = sizes[1].select(*[F.col(c).alias(f"other_{c}") for c in sizes[1].columns])
    # Classes grow with the logarithm of the length: a few dozen of each side.
    fits = (F.col("long") >= band * F.col("other_short")) & (F.col("other_long") >= band * F.col("short"))
    pairs = durable(sizes[0].join(F.broadcast(other), fits))

    def dealt(side: DataFrame, own: str, far: str, columns: list[Column]) -> DataFrame:
        """Each text once for every block of a compatible class of the other side."""
        of = pairs.select(
            F.col(f"{own}cls").alias("cls"), F.col(f"{far}cls").alias("far_cls"), F.col(f"{own}parts").alias("own_parts"), F.col(f"{far}parts").alias("far_parts")
        )
        part = F.pmod(F.xxhash64("text"), F.col("own_parts"))
        met = side.join(F.broadcast(of), "cls").withColumn("part", part)
        blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("far_parts") - 1)).alias("far_part")
        return met.select("cls", "part", "far_cls", blocks, *columns)

    left = dealt(sides[0], "", "other_", [F.col("text"), F.col("floor")])
    right = dealt(sides[1], "other_", "", [F.col("text").alias("of"), F.col("pos"), F.col("entry")])
    # One name for one column on each side: they come from different tables, but classes are joined from one.
    right = right.toDF("y_cls", "y_part", "x_cls", "x_part", "of", "pos", "entry")
    met = left.groupBy("cls", "part", "far_cls", "far_part").cogroup(right.groupBy("x_cls", "x_part", "y_cls", "y_part"))
    return met.applyInPandas(_meet, FOUND)


def matches_from(
    codes: DataFrame,
    catalogue: DataFrame,
    threshold: float = 85,
    code: str = "cod_articulo",
    entry: str = "CODART",
    order: str = "catalogue_pos",
    match: str = "CODART_A3",
    score: str = "Fuzzy_Score",
) -> DataFrame:
    """``(code, match, score)`` of every distinct code whose best rounded score is at least ``threshold``.

    The first entry of the highest score wins, by the unrounded score. Null codes and entries, and those without a letter
    or digit, match nothing.
    """
    entries = durable(
        catalogue.where(F.col(entry).isNotNull())
        .groupBy(token_text(entry).alias("text"))
        .agg(F.min(F.struct(F.col(order).cast("long").alias("pos"), F.col(entry).alias("entry"))).alias("e"))
        .where(F.col("text") != "")
        .select("text", "e.pos", "e.entry")
    )
    named = codes.where(F.col(code).isNotNull()).select(code).distinct().withColumn("text", token_text(code))
    texts = durable(named.select("text").distinct().where(F.col("text") != ""))
    frequency = durable(
        entries.select(F.explode(F.split("text", " ")).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    )
    shared = durable(_shared(_by_rarity(texts, frequency), _by_rarity(entries, frequency), threshold))
    floors = texts.join(shared.select("text", "score"), "text", "left")
    raw = least_raw(threshold)
    open_codes = floors.where(F.coalesce("score", F.lit(0.0)) < EXACT).select("text", F.coalesce("score", F.lit(raw)).alias("floor"))
    best = _best(shared.unionByName(_near(open_codes, entries, threshold)))
    found = named.join(best, "text").withColumn(score, F.bround("score").cast("int")).withColumn(match, F.col("entry"))
    return found.where(F.col(score) >= threshold).select(code, match, score)
