"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed into cells of source x language x topic. Raking scales the cells in turn to the target share of each
source, language and topic until all three hold. A cell's raked mass over its tokens is the weight of a token there.

Inclusion probabilities come from raking the weights once more to the token counts that the budget gives each margin, with no
cell above its own tokens: full cells stay full, the others make up for them, until the expected sample meets all margins. A
budget is lowered to what a given share allows (a value can't give more tokens than it has), and by steps of STEP where the
margins can't be met together; default shares are cut to what their values have. `margins` reports what is reached. A document
is sampled when its hash, uniform in [0, 1), is under its cell's probability.

Only cells leave the documents. While their counted number is under MAX_CELLS they are raked in driver memory (a bounded
table); beyond it the same steps run as aggregations over a table of cells.

Targets: a share for each value, scaled to sum 1; a margin without given shares gets tokens**TEMPERATURE, which
brings a hot source nearer to the others. Raking that doesn't reach the margins within TOLERANCE in ROUNDS rounds, as where the
cells with tokens cannot meet the targets at all, gives the last round's weights, which meet the last margin, and a warning that
names the others and how far off they are.

The topic is the documents' own column `topic` if they have one, else the form of the text, see topic().

Defined cases: a null source, language or topic is the value '(none)'; null and empty texts have no token, an inclusion
probability of their cell like others, and 0 in a cell without tokens; values without a target share get probability 0
when shares are given for their margin; target shares of values without tokens are left out; repeated rows with the same
text are sampled alike; an empty table gives no rows; very long texts are counted whole; further columns pass through, but those
that `mixed` adds replace columns of their names.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm import common

MARGINS = ("source", "lang", "topic")
TEMPERATURE = 0.5
BUDGET = 0.6
ROUNDS = 100
#: How far a share of all tokens may be from its target.
TOLERANCE = 1e-7
#: Bounded raking: how far a share of the sample may be off, rounds without gain that end it, the step and the least of the budget.
REACHED, PATIENCE, STEP, LOWEST = 1e-7, 20, 0.9, 0.01
MAX_CELLS = 100_000
SEED = 17

Targets = dict[str, dict[str, float]]


def tokens(text: Column) -> Column:
    """Words between white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """A topic from the form of a text, for tables without a column of topics."""
    n = F.length(text)
    return (
        F.when(F.contains(text, F.lit(" | ")), "tabular")
        .when(F.contains(text, F.lit("icensed under")) | F.contains(text, F.lit("eleased under")), "licensed")
        .when(n >= 8000, "long")
        .when(n < 500, "short")
        .otherwise("prose")
    )


def shares(total: dict[str, float], given: dict[str, float] | None, temperature: float) -> dict[str, float]:
    """Target share of each value that has tokens."""
    raw = {v: (given.get(v, 0.0) if given is not None else t**temperature) for v, t in sorted(total.items()) if t > 0}
    s = sum(raw.values())
    return {v: x / s for v, x in raw.items()} if s else raw


def factor(mass: np.ndarray, weight: np.ndarray, budget: float) -> float:
    """The factor f at which sum(mass * min(1, f * weight)) is the budget; infinity if all mass is under it."""
    use = weight > 0
    order = np.argsort(-weight[use], kind="stable")
    m, w = mass[use][order], weight[use][order]
    full = np.concatenate([[0.0], np.cumsum(m)])
    rest = np.concatenate([np.cumsum((m * w)[::-1])[::-1], [0.0]])
    for n in range(len(m)):  # the n cells of greatest weight are kept whole
        f = (budget - full[n]) / rest[n]
        if f * w[n] <= 1:
            return max(f, 0.0)
    return float("inf")


def _met(off: dict[str, float]) -> None:
    """Warns of margins whose shares are farther off than TOLERANCE."""
    far = {m: x for m, x in off.items() if not x < TOLERANCE}
    if far:
        warnings.warn("raking doesn't meet its targets: " + ", ".join(f"{m} is off by {x:.2g}" for m, x in far.items()), stacklevel=3)


def rake_local(rows: list[tuple], targets: Targets | None, temperature: float, budget: float) -> list[tuple]:
    """(source, lang, topic, weight, probability) of cells (source, lang, topic, tokens)."""
    rows = sorted(rows)
    mass = np.array([r[3] for r in rows], dtype=np.float64)
    w = mass / max(mass.sum(), 1)
    index, goal = [], []
    for k, margin in enumerate(MARGINS):
        names = sorted({r[k] for r in rows})
        at = {v: n for n, v in enumerate(names)}
        i = np.array([at[r[k]] for r in rows], dtype=np.int64)
        total = np.bincount(i, weights=mass, minlength=len(names))
        share = shares(dict(zip(names, total, strict=True)), (targets or {}).get(margin), temperature)
        index.append(i)
        goal.append(np.array([share.get(v, 0.0) for v in names]))
    for _ in range(ROUNDS):
        for i, g in zip(index, goal, strict=True):
            now = np.bincount(i, weights=w, minlength=len(g))
            w = w * np.divide(g, now, out=np.zeros_like(g), where=now > 0)[i]
        off = [np.abs(np.bincount(i, weights=w, minlength=len(g)) - g).max(initial=0) for i, g in zip(index, goal, strict=True)]
        if max(off) < TOLERANCE:
            break
    _met(dict(zip(MARGINS, map(float, off), strict=True)))
    weight = np.divide(w * mass.sum(), mass, out=np.zeros_like(w), where=mass > 0)
    p = calibrated(mass, weight, index, goal, [m in (targets or {}) for m in MARGINS], budget * mass.sum(), max(off) < TOLERANCE)
    return [(*r[:3], float(a), float(b)) for r, a, b in zip(rows, weight, p, strict=True)]


def reachable(total: np.ndarray, share: np.ndarray, tokens: float) -> np.ndarray:
    """Tokens for each value in proportion to its share, none more than it has."""
    ratio = np.divide(share, total, out=np.zeros_like(share), where=total > 0)
    return total * np.minimum(1, min(factor(total, ratio, tokens), 1e300) * ratio)


def calibrated(mass: np.ndarray, weight: np.ndarray, index: list[np.ndarray], goal: list[np.ndarray], given: list[bool], tokens: float, met: bool) -> np.ndarray:
    """Inclusion probabilities of cells: min(1, the weight times a factor of each margin's value), such that the expected tokens
    meet the margins; without margins that the weights meet, min(1, the weight times one factor)."""
    total = [np.bincount(i, weights=mass, minlength=len(g)) for i, g in zip(index, goal, strict=True)]
    asked = tokens
    for t, g, own in zip(total, goal, given, strict=True):
        if own and (g > 0).any():
            tokens = min(tokens, (t[g > 0] / g[g > 0]).min())
    while met and tokens > LOWEST * asked > 0:
        want = [tokens * g if own else reachable(t, g, tokens) for t, g, own in zip(total, goal, given, strict=True)]
        u, best, since = weight * mass * tokens / mass.sum(), np.inf, 0
        while since < PATIENCE:
            for i, x in zip(index, want, strict=True):
                full = np.bincount(i, weights=np.where(u >= mass, mass, 0), minlength=len(x))
                rest = np.bincount(i, weights=np.where(u >= mass, 0, u), minlength=len(x))
                now = full + rest
                scale = np.divide(x - full, rest, out=np.ones_like(x), where=(rest > 0) & (x > full))
                scale = np.where((x <= full) & (now > 0), np.divide(x, now, out=np.zeros_like(x), where=now > 0), scale)
                u = u * scale[i]
            off = max(np.abs(np.bincount(i, weights=np.minimum(u, mass), minlength=len(x)) - x).max(initial=0) for i, x in zip(index, want, strict=True)) / tokens
            if off < REACHED:
                return np.minimum(1, np.divide(u, mass, out=np.zeros_like(u), where=mass > 0))
            best, since = (off, 0) if off < 0.9 * best else (best, since + 1)
        tokens *= STEP
    f = factor(mass, weight, asked)
    return np.where(weight > 0, np.minimum(1, np.where(weight > 0, f, 0) * weight), 0)


def rake_table(cells: DataFrame, targets: Targets | None, temperature: float, budget: float) -> DataFrame:
    """rake_local as aggregations over cells(source, lang, topic, tokens), for any number of them."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    w = cells.withColumn("w", F.col("tokens") / max(total, 1))
    goals = {}
    for m in MARGINS:
        g = cells.groupBy(m).agg(F.sum("tokens").alias("t")).where("t > 0")
        if (given := (targets or {}).get(m)) is not None:
            given_rows = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in given.items()] or [("", 0.0)], f"{m} string, raw double")
            g = g.join(given_rows, m, "left").select(m, F.coalesce("raw", F.lit(0.0)).alias("raw"))
        else:
            g = g.select(m, F.pow("t", F.lit(temperature)).alias("raw"))
        s = g.agg(F.sum("raw")).first()[0] or 1
        goals[m] = common.stored(g.select(m, (F.col("raw") / s).alias("goal")), "goals")
    for _ in range(ROUNDS):
        for m in MARGINS:
            now = w.groupBy(m).agg(F.sum("w").alias("now"))
            scale = now.join(goals[m], m, "left").select(m, F.when(F.col("now") > 0, F.coalesce("goal", F.lit(0.0)) / F.col("now")).otherwise(0.0).alias("scale"))
            w = w.join(scale, m).withColumn("w", F.col("w") * F.col("scale")).drop("scale")
        w = common.stored(w, "cells")
        off = {m: w.groupBy(m).agg(F.sum("w").alias("now")).join(goals[m], m, "left").agg(F.max(F.abs(F.col("now") - F.coalesce("goal", F.lit(0.0))))).first()[0] or 0.0 for m in MARGINS}
        if max(off.values()) < TOLERANCE:
            break
    _met(off)
    w = common.stored(w.withColumn("weight", F.when(F.col("tokens") > 0, F.col("w") * total / F.col("tokens")).otherwise(0.0)), "weights")
    p = calibrated_table(w, goals, set(targets or {}), budget * total, max(off.values()) < TOLERANCE)
    return p.select(*MARGINS, "weight", "probability")


def calibrated_table(cells: DataFrame, goals: dict[str, DataFrame], given: set[str], tokens: float, met: bool) -> DataFrame:
    """cells(MARGINS, tokens, weight, ...) with probability, as calibrated() gives them; goals: (value, goal) of each margin."""
    asked, of = tokens, {}
    for m in MARGINS:
        have = cells.groupBy(m).agg(F.sum("tokens").alias("have"))
        of[m] = common.stored(have.join(goals[m], m, "left").select(m, "have", F.coalesce("goal", F.lit(0.0)).alias("goal")), "margins")
        if m in given:
            least = of[m].where("goal > 0").agg(F.min(F.col("have") / F.col("goal"))).first()[0]
            tokens = min(tokens, tokens if least is None else least)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    while met and tokens > LOWEST * asked > 0:
        want = {}
        for m in MARGINS:
            f = tokens if m in given else table_factor(of[m].where("goal > 0"), F.col("have"), F.col("goal") / F.col("have"), tokens)
            want[m] = of[m].select(m, F.when(F.col("goal") > 0, F.col("goal") * f if m in given else F.least(F.col("have").cast("double"), F.col("goal") * f)).otherwise(0.0).alias("want"))
        u, best, since = cells.withColumn("u", F.col("weight") * F.col("tokens") * tokens / total), float("inf"), 0
        while since < PATIENCE:
            for m in MARGINS:
                sums = u.groupBy(m).agg(F.sum(F.when(F.col("u") >= F.col("tokens"), F.col("tokens")).otherwise(0)).alias("full"), F.sum(F.when(F.col("u") < F.col("tokens"), F.col("u")).otherwise(0.0)).alias("rest"))
                now = F.col("full") + F.col("rest")
                scale = F.when((F.col("want") <= F.col("full")) & (now > 0), F.col("want") / now).when((F.col("want") > F.col("full")) & (F.col("rest") > 0), (F.col("want") - F.col("full")) / F.col("rest")).otherwise(1.0)
                u = u.join(sums.join(want[m], m).select(m, scale.alias("scale")), m).withColumn("u", F.col("u") * F.col("scale")).drop("scale")
            u = common.stored(u, "bounded")
            held = F.sum(F.least(F.col("u"), F.col("tokens").cast("double")))
            off = max((u.groupBy(m).agg(held.alias("now")).join(want[m], m).agg(F.max(F.abs(F.col("now") - F.col("want")))).first()[0] or 0.0) for m in MARGINS) / tokens
            if off < REACHED:
                return u.withColumn("probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("u") / F.col("tokens"))).otherwise(0.0))
            best, since = (off, 0) if off < 0.9 * best else (best, since + 1)
        tokens *= STEP
    f = table_factor(cells.where("weight > 0"), F.col("tokens"), F.col("weight"), asked)
    return cells.withColumn("probability", F.when(F.col("weight") > 0, F.least(F.lit(1.0), F.lit(f) * F.col("weight"))).otherwise(0.0))


def table_factor(rows: DataFrame, mass: Column, weight: Column, budget: float) -> float:
    """factor() by aggregations: rows past 1 are kept whole, the factor rises for the others, until no more pass."""
    f, last = 0.0, None
    while f != last:
        last = f
        whole, rest = rows.agg(F.sum(F.when(weight * f >= 1, mass)), F.sum(F.when(weight * f < 1, mass * weight))).first()
        f = max((budget - (whole or 0)) / rest, last) if rest else float("inf")
        if f == float("inf"):
            break
    return f


def margins(documents: DataFrame) -> DataFrame:
    """(margin, value, share, expected) of mixed documents: a value's share of all tokens and of the expected sample's."""
    out = None
    for m in MARGINS:
        one = documents.groupBy(F.lit(m).alias("margin"), F.col(f"__{m}").alias("value")).agg(F.sum("__tokens").alias("t"), F.sum(F.col("__tokens") * F.col("__probability")).alias("e"))
        out = one if out is None else out.unionAll(one)
    whole = documents.agg(F.sum("__tokens").alias("all_t"), F.sum(F.col("__tokens") * F.col("__probability")).alias("all_e"))
    return out.select("margin", "value", (F.col("t") / whole.select("all_t").scalar()).alias("share"), (F.col("e") / whole.select("all_e").scalar()).alias("expected"))


def mixed(documents: DataFrame, targets: Targets | None = None, budget: float = BUDGET, temperature: float = TEMPERATURE, seed: int = SEED, max_cells: int = MAX_CELLS, topic_of=None) -> DataFrame:
    """documents with __topic, __tokens, __weight, __probability and __sampled, and __source and __lang as they are raked."""
    named = lambda c: F.coalesce(c.cast("string"), F.lit("(none)"))
    own = topic_of(F.col("text")) if topic_of else F.col("topic") if "topic" in documents.columns else topic(F.col("text"))
    rows = documents.select(common.boxed(documents), named(F.col("source")).alias("source"), named(F.col("lang")).alias("lang"), named(own).alias("topic"), tokens(F.col("text")).alias("tokens"), F.col("doc_id").alias("id"), F.col("text").alias("text"))
    counted = common.stored(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")), "cells")
    cells, documents_ = counted.select(*MARGINS, "tokens"), counted.agg(F.sum("n")).first()[0] or 0
    few = common.few(cells, max_cells)
    if few:
        local = rake_local([tuple(r) for r in cells.collect()], targets, temperature, budget)  # max_cells rows at most
        raked = cells.sparkSession.createDataFrame(local, ", ".join(f"{m} string" for m in MARGINS) + ", weight double, probability double")
    else:
        raked = rake_table(cells, targets, temperature, budget)
    raked = raked.join(counted.select(*MARGINS, "n"), list(MARGINS)).select(F.struct(*MARGINS).alias("cell"), "n", "weight", "probability")
    rows = rows.withColumn("cell", F.struct(*MARGINS))
    both = rows.join(F.broadcast(raked.drop("n")), "cell") if few else common.joined(rows, common.stored(raked, "raked"), "cell", documents_)
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))), 11) / F.lit(float(1 << 53))
    return both.select(*common.unboxed(both, __source=F.col("source"), __lang=F.col("lang"), __topic=F.col("topic"), __tokens=F.col("tokens"), __weight=F.col("weight"), __probability=F.col("probability"), __sampled=chance < F.col("probability")))


def sampled(documents: DataFrame, **how) -> DataFrame:
    """The documents that are sampled, with their own columns."""
    out = mixed(documents.select(common.boxed(documents), "doc_id", "text", "source", "lang", *["topic"] * ("topic" in documents.columns)), **how).where("__sampled")
    return out.select(*common.unboxed(out))


#: Shares of tokens that the query mixes to; sources keep the default, which the shares of their tokens give.
TARGETS: Targets = {"lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}}


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(common.read(spark, sf_dir, "documents"), TARGETS)
    return out.select("doc_id", "source", "lang", *(F.col(f"__{c}").alias(c) for c in ("topic", "tokens", "weight", "probability", "sampled")))
