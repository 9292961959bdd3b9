"""Mixing to target weights with soft membership, in DataFrame operations only.

A labelled table teaches a classifier: naive Bayes over the words most frequent in the labelled rows, learned with
two aggregations. Each document gets posterior probabilities over the domains (soft membership), so one that mixes
domains counts towards each of them. Rates r >= 0 are then fitted so that the expected tokens of each domain,
sum(r * tokens * posterior), meet the targets in the least-squares sense. Projected gradient descent needs only the
domains' current totals, a few numbers, from each pass; a document's rate is a pure function of its posterior and of
the gradients so far, so nothing is stored for each document between passes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlane.llm import common

def _words(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), common.SPACE_RE)


def token_count(text: str = "text") -> Column:
    return F.size(F.filter(_words(text), lambda w: w != "")).cast("long")


def learn_domains(
    labelled: DataFrame, label: str, most: int = 4000, listed: list[str] | None = None, vocabulary: int = 1000, most_domains: int = 64
) -> tuple[list[str], list[float], DataFrame]:
    """Domains, their log priors and the table (word, ll_0 .. ll_k-1) of log likelihoods: `vocabulary` words and one
    row (null) for all others.

    Learns from at most `most` labelled rows in the order of an id hash; the counts of domains come from all rows.
    With over `most_domains` labels the rarest that aren't `listed` are one domain together, the last one. The three
    bounds are parameters.
    """
    known = labelled.filter(F.col(label).isNotNull())
    found = known.groupBy(label).count()
    first = F.col(label).isin(listed or [])
    priors = found.orderBy(F.desc(first), F.desc("count"), label).limit(most_domains + 1).collect()
    if len(priors) > most_domains:
        priors = sorted(tuple(x) for x in priors[: max(most_domains - 1, len(listed or []))])
        own, rest = [x[0] for x in priors], "other"
        while rest in own:
            rest += "*"
        known = known.withColumn(label, F.when(F.col(label).isin(own), F.col(label)).otherwise(rest))
        priors.append((rest, found.filter(~F.col(label).isin(own)).agg(F.sum("count")).first()[0]))
    else:
        priors = sorted(tuple(x) for x in priors)
    names, total = [r[0] for r in priors], sum(r[1] for r in priors)
    if not names:
        return [], [], labelled.select(F.lit("").alias("word")).limit(0)
    sample = common.hash_sample(known.filter(F.col("doc_id").isNotNull()).select("doc_id", "text", label), "doc_id", most, total)
    words = sample.select(label, F.explode(_words()).alias("word")).filter("word != ''")
    counts = common.materialise(words.groupBy("word").agg(*[F.count_if(F.col(label) == n).alias(f"n_{i}") for i, n in enumerate(names)], F.count(F.lit(1)).alias("n")))
    sums = [x or 0 for x in counts.agg(*[F.sum(f"n_{i}") for i in range(len(names))]).first()]
    likely = lambda n, i: F.log((n + 0.5) / (sums[i] + 0.5 * (vocabulary + 1))).alias(f"ll_{i}")
    top = common.materialise(counts.orderBy(F.desc("n"), "word").limit(vocabulary))
    rows = top.select("word", *[likely(F.col(f"n_{i}"), i) for i in range(len(names))])
    rest = top.agg(*[F.coalesce(F.sum(f"n_{i}"), F.lit(0)).alias(f"n_{i}") for i in range(len(names))])
    rest = rest.select(F.lit(None).cast("string").alias("word"), *[likely(sums[i] - F.col(f"n_{i}"), i) for i in range(len(names))])
    return names, [math.log(r[1] / total) for r in priors], common.materialise(rows.unionByName(rest))


def posteriors(docs: DataFrame, names: list[str], log_prior: list[float], table: DataFrame, evidence: float = 50.0) -> DataFrame:
    """(doc_id, n_tokens, p) for each row of docs: p holds the domains' probabilities in the order of names.

    A text counts as `evidence` words at most: its mean log likelihood is scaled to that many, so that long texts of
    mixed kinds stay members of several domains. The table is as long as its vocabulary, a parameter, which bounds
    what is broadcast. Words outside it count alike, through their number. Texts without words, null ones too, have
    the prior. Rows are told apart by their place, so repeated and null ids are rows of their own.
    """
    k = len(names)
    rest = table.filter("word is null").first()
    known = table.filter("word is not null")
    words = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    words = words.select("row", "doc_id", F.explode_outer(_words()).alias("word"))
    found = words.join(F.broadcast(known), "word", "left")
    sums = found.groupBy("row").agg(
        F.any_value("doc_id").alias("doc_id"), F.count_if(F.col("word") != "").alias("n_tokens"), F.count("ll_0").alias("hits"), *[F.coalesce(F.sum(f"ll_{i}"), F.lit(0.0)).alias(f"s_{i}") for i in range(k)]
    )
    weight = F.least(F.lit(1.0), evidence / F.greatest(F.col("n_tokens"), F.lit(1)))
    z = [F.lit(log_prior[i]) + weight * (F.col(f"s_{i}") + (F.col("n_tokens") - F.col("hits")) * rest[f"ll_{i}"]) for i in range(k)]
    out = sums.select("doc_id", "n_tokens", F.array(*z).alias("z"))
    out = out.withColumn("e", F.transform("z", lambda x: F.exp(x - F.array_max("z"))))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return out.select("doc_id", "n_tokens", F.transform("e", lambda x: x / total).alias("p"))


def _rate(gradients: list[list[float]], k: int) -> Column:
    """The rate after all steps: r = max(0, r - p . g) from r = 1, folded over the gradients."""
    r = F.lit(1.0)
    if not gradients:
        return r
    steps = F.array(*[F.array(*map(F.lit, g)) for g in gradients])
    dot = lambda g: sum((F.element_at("p", i + 1) * F.element_at(g, i + 1) for i in range(k)), F.lit(0.0))
    return F.aggregate(steps, r, lambda acc, g: F.greatest(F.lit(0.0), acc - dot(g)))


def fit_rates(members: DataFrame, targets: list[float | None], rounds: int = 40, tolerance: float = 1e-3) -> tuple[Column, list[float], list[float]]:
    """The rate as a column over p, the expected totals reached and the targets in tokens.

    Minimises the sum over domains of (total - target)^2 by projected gradient descent, in the metric that weighs a
    document by its tokens: so a step changes r by p . g whatever the document's length. The step is one over the
    largest row sum of the matrix sum(tokens * p * p'), which bounds its curvature. Starts at r = 1, ends when the
    totals are within `tolerance` of the targets, or after `rounds`. With no token in the table all rates stay 1.
    A target of None keeps the domain's present total; the others share the rest of the tokens.
    """
    k = len(targets)
    p = [F.element_at("p", i + 1) for i in range(k)]
    first = members.agg(F.sum("n_tokens"), *[F.sum(F.col("n_tokens") * a * b) for a in p for b in p]).first()
    tokens = first[0] or 0
    if not tokens:
        return F.lit(1.0), [0.0] * k, [0.0] * k
    matrix = [[first[1 + i * k + j] for j in range(k)] for i in range(k)]
    kept = [sum(matrix[i]) if t is None else 0.0 for i, t in enumerate(targets)]
    weights = sum(t or 0.0 for t in targets) or 1
    goal = [x if t is None else t / weights * (tokens - sum(kept)) for t, x in zip(targets, kept, strict=True)]
    scale = [1 / math.sqrt(max(sum(matrix[i]), 1e-9 * tokens)) for i in range(k)]  # domains of any size move alike
    curve = max(sum(matrix[i][j] * scale[i] * scale[j] for j in range(k)) for i in range(k))
    gradients: list[list[float]] = []
    reached = goal
    for _ in range(rounds + 1):
        rate = _rate(gradients, k)
        reached = list(members.select(F.col("n_tokens") * rate.alias("w"), "p").toDF("w", "p").agg(*[F.sum(F.col("w") * x) for x in p]).first())
        off = [a - b for a, b in zip(reached, goal, strict=True)]
        if max(map(abs, off)) <= tolerance * tokens or len(gradients) == rounds:
            break
        gradients.append([o * s * s / curve for o, s in zip(off, scale, strict=True)])
    return _rate(gradients, k), reached, goal


def mix(docs: DataFrame, labelled: DataFrame, label: str, targets: dict[str, float] | None = None, rounds: int = 40) -> DataFrame:
    """doc_id, n_tokens, p (posterior by domain, domains in order), domains, rate, goal, reached and unmet for each row
    of docs.

    targets maps domains to weights; those missing keep their present share of the tokens. By default all weigh the
    same. Rates are finite and nonnegative; the expected tokens of all domains together stay those of docs. goal and
    reached are the domains' expected tokens, wanted and fitted, the same in each row. A domain with a target but no
    labelled row can't be met: it is named in unmet, and the others share its weight. Without a labelled row there is
    one domain and all rates are 1. Repeated rows, null ids and null texts have rows of their own; an empty table gives
    an empty result; other columns play no part.
    """
    names, prior, table = learn_domains(labelled, label, listed=list(targets or {}))
    unmet = F.array(*[F.lit(n) for n, w in sorted((targets or {}).items()) if w and n not in names]).cast("array<string>").alias("unmet")
    fixed = lambda values, kind: F.array(*map(F.lit, values)).cast(f"array<{kind}>")
    if not names:
        n = token_count().alias("n_tokens")
        return docs.select("doc_id", n, fixed([1.0], "double").alias("p"), fixed(["all"], "string").alias("domains"), F.lit(1.0).alias("rate"), fixed([], "double").alias("goal"), fixed([], "double").alias("reached"), unmet)
    members = common.materialise(posteriors(docs, names, prior, table))
    wanted = [float(targets[n]) if n in targets else None for n in names] if targets else [1.0] * len(names)
    rate, reached, goal = fit_rates(members, wanted, rounds)
    return members.select("doc_id", "n_tokens", "p", fixed(names, "string").alias("domains"), rate.alias("rate"), fixed(goal, "double").alias("goal"), fixed(reached, "double").alias("reached"), unmet)


def copies(rate: str = "rate", seed: int = 17) -> Column:
    """Whole copies of a document at its rate: the floor, and one more with the fraction's probability (by id hash)."""
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + F.when(draw < F.col(rate) - F.floor(rate), 1).otherwise(0)).cast("int")
