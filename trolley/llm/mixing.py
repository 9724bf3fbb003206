"""Temperature mixing of sources, realised as budgeted block permutations. Built-in expressions only.

Shares p of the sources in all tokens are raised to an exponent and normalised: w ~ p ** a, from the
natural mix (a = 1) to equal weights (a = 0). The exponent is bisected to the target entropy (a share
of the largest possible one), but not below the one at which the most repeated source reaches the
limit of repetitions. Without a budget the mix is as large as it must be for every document to
appear at least once; with one, sources get their weights' shares of it, repeated or in part.

Each pass over a source (epoch) is a permutation of its documents: by blocks, numbered by a hash of
epoch and document, and by the hash in a block. A source has about the square root of its documents
in blocks, so neither a block nor the sums over blocks are large. The last, partial epoch ends where
its tokens would pass the budget. Its end is one block and one hash per source, so documents
choose their copies by comparing with it: no text is shuffled.

Rows: every input row is one document; tokens are runs of non-spaces, a null text has none. A null
source is a source of its own. A null id is replaced by the text's hash. Rows of one id are placed
together: both are in a partial epoch or neither. Sources without tokens appear once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trolley.llm.common import stored

ENTROPY = 0.98
REPEATS = 2.0
STEPS = 60
SEED = "mix"


def tokens(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \t\n\r]+")), F.lit(0)).cast("bigint")


def _identity() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))


def _hash(epoch: Column, identity: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(SEED), epoch.cast("string"), identity))


def _block(hashed: Column, blocks: Column) -> Column:
    return F.conv(F.substring(hashed, 1, 8), 16, 10).cast("bigint") % blocks


def _bisected(above) -> Column:
    """The exponent in [0, 1] at which ``above`` turns from true (small exponents) to false."""

    def halve(range_: Column, _: Column) -> Column:
        mid = (range_["lo"] + range_["hi"]) / 2
        up = above(mid)
        return F.struct(
            F.when(up, mid).otherwise(range_["lo"]).alias("lo"), F.when(up, range_["hi"]).otherwise(mid).alias("hi")
        )

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, halve, lambda r: (r["lo"] + r["hi"]) / 2)


def _sum(values: Column, term) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + term(x))


def weights(sources: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: float | None = None) -> DataFrame:
    """``group, documents, tokens, weight, share_of_budget`` (tokens to take) for rows ``group,
    documents, tokens``. One row per source is gathered in one row: sources are the mix's dimensions."""
    used = sources.where("tokens > 0")
    one = used.agg(F.sort_array(F.collect_list(F.struct("group", "tokens"))).alias("s"), F.sum("tokens").cast("double").alias("all"))
    logs = F.transform("s", lambda x: F.log(x["tokens"] / F.col("all")))
    one = one.withColumn("logs", logs).withColumn("n", F.size("s").cast("double"))
    v = F.col("logs")

    def spread(a: Column) -> Column:
        """Entropy of the weights at exponent a."""
        z = _sum(v, lambda x: F.exp(a * x))
        return F.log(z) - a * _sum(v, lambda x: x * F.exp(a * x)) / z

    def most(a: Column) -> Column:
        """Repetitions of the most repeated source."""
        if budget is None:
            return F.exp((1 - a) * (F.array_max(v) - F.array_min(v)))
        z = _sum(v, lambda x: F.exp(a * x))
        return F.exp((a - 1) * F.array_min(v)) / z * budget / F.col("all")

    one = one.withColumn("by_entropy", _bisected(lambda a: spread(a) > F.lit(entropy) * F.log("n")))
    one = one.withColumn("by_limit", _bisected(lambda a: most(a) > F.lit(repeats)))
    one = one.withColumn("a", F.greatest("by_entropy", "by_limit"))
    one = one.withColumn("z", _sum(v, lambda x: F.exp(F.col("a") * x)))
    size = F.lit(budget) if budget is not None else F.col("all") * F.col("z") * F.exp((1 - F.col("a")) * F.array_max(v))
    one = one.withColumn("size", size)
    flat = one.select("a", "z", "size", "all", F.explode("s").alias("x"))
    weight = F.exp(F.col("a") * F.log(F.col("x.tokens") / F.col("all"))) / F.col("z")
    flat = flat.select(F.col("x.group").alias("group"), weight.alias("weight"), (weight * F.col("size")).alias("share_of_budget"))
    return sources.join(flat, "group", "left").select(
        "group", "documents", "tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("share_of_budget", F.lit(0.0)).alias("share_of_budget")
    )


def plan(documents: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: float | None = None) -> DataFrame:
    """What each source's documents need to choose their copies: ``group, weight, blocks, full`` (whole
    epochs) and the end of the partial epoch, ``last_block`` and ``last_hash``."""
    light = documents.select(_group().alias("group"), _identity().alias("identity"), tokens("text").alias("tokens"))
    light = stored(light, "mix-rows")
    sources = light.groupBy("group").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))
    full = F.when(F.col("tokens") == 0, 1).otherwise(F.floor(F.col("share_of_budget") / F.col("tokens") + 1e-9)).cast("int")
    mix = weights(sources, entropy, repeats, budget)
    mix = mix.withColumns({"full": full, "blocks": F.ceil(F.sqrt("documents")).cast("bigint")})
    rest = F.floor(F.col("share_of_budget") - F.col("full") * F.col("tokens") + 1e-6).cast("bigint")
    mix = stored(mix.withColumn("rest", F.greatest(rest, F.lit(0))), "mix-sources")
    wanted = mix.where("rest > 0").select("group", "full", "blocks", "rest")
    part = light.join(wanted, "group").withColumn("hash", _hash(F.col("full"), F.col("identity")))
    part = part.withColumn("block", _block(F.col("hash"), F.col("blocks")))
    sums = part.groupBy("group", "rest", "block").agg(F.sum("tokens").alias("held"))
    before = Window.partitionBy("group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
    ends = sums.where("before <= rest AND rest < before + held").groupBy("group").agg(F.min(F.struct("block", "before")).alias("e"))
    ends = ends.select("group", F.col("e.block").alias("block"), F.col("e.before").alias("before"))
    upto = Window.partitionBy("group").orderBy("hash").rangeBetween(Window.unboundedPreceding, 0)
    inside = part.join(ends, ["group", "block"]).withColumn("upto", F.sum("tokens").over(upto))
    last = inside.where("before + upto <= rest").groupBy("group").agg(F.max("hash").alias("last_hash"))
    cuts = ends.select("group", F.col("block").alias("last_block")).join(last, "group", "left")
    return stored(mix.join(cuts, "group", "left").select("group", "weight", "blocks", "full", "last_block", "last_hash"), "mix-plan")


def _group() -> Column:
    """Sources as a key that is never null: a mark tells a null from the name."""
    return F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("source").cast("string")))


def copies(documents: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: float | None = None) -> DataFrame:
    """``row`` (a row of ``documents``) as often as the mix takes it, with ``epoch``, ``block`` and
    ``hash`` (a source's order is by these three) and the source's ``weight``."""
    chosen = plan(documents, entropy, repeats, budget)
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    rows = documents.select(row, _group().alias("group"), _identity().alias("identity"))
    # A few rows per source: Spark broadcasts them if they are small, or splits a hot source's rows.
    rows = rows.join(chosen, "group")

    def placed(epoch: Column) -> Column:
        hashed = _hash(epoch, F.col("identity"))
        return F.struct(epoch.alias("epoch"), _block(hashed, F.col("blocks")).alias("block"), hashed.alias("hash"))

    def taken(x: Column) -> Column:
        last = F.col("last_block")
        early = (x["block"] < last) | ((x["block"] == last) & (x["hash"] <= F.col("last_hash")))
        return (x["epoch"] < F.col("full")) | F.coalesce(early, F.lit(False))

    found = F.filter(F.transform(F.sequence(F.lit(0), F.col("full")), placed), taken)
    return rows.select("row", "weight", F.explode(found).alias("copy")).select("row", "weight", "copy.*")


def mix(documents: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: float | None = None) -> DataFrame:
    """The rows of ``documents``, each as often as the mix takes it."""
    return copies(documents, entropy, repeats, budget).select("row.*")


def mixed_report(documents: DataFrame) -> DataFrame:
    """``doc_id, source, tokens, weight, epoch, block, hash``: a row for each copy in the mix."""
    return copies(documents.select("doc_id", "source", "text")).select(
        "row.doc_id", "row.source", tokens("row.text").alias("tokens"), F.round("weight", 9).alias("weight"),
        "epoch", "block", "hash",
    )


def _oracle() -> str:
    z = "list_sum(list_transform(v, lambda x: exp(a * x)))"
    h = f"md5(concat('{SEED}:', {{epoch}}, ':', identity))"
    block = f"CAST(concat('0x', substr({h}, 1, 8)) AS BIGINT) % blocks"
    bisect = """{name} AS (
  SELECT 1 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, 0.5::DOUBLE AS a FROM one
  UNION ALL
  SELECT step + 1, CASE WHEN {test} THEN a ELSE lo END, CASE WHEN {test} THEN hi ELSE a END,
    (CASE WHEN {test} THEN a ELSE lo END + CASE WHEN {test} THEN hi ELSE a END) / 2
  FROM {name}, one WHERE step <= {steps})"""
    entropy = f"ln({z}) - a * list_sum(list_transform(v, lambda x: x * exp(a * x))) / {z} > {ENTROPY} * ln(n)"
    limit = f"exp((1 - a) * (list_max(v) - list_min(v))) > {REPEATS}"
    partial, listed = h.format(epoch='"full"'), h.format(epoch="epoch")
    return f"""
WITH RECURSIVE light AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS grp,
    coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS identity,
    coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')), 0) AS tokens
  FROM documents),
sources AS (SELECT grp, count(*) AS docs, sum(tokens)::BIGINT AS held FROM light GROUP BY grp),
one AS (SELECT list(ln(held / total) ORDER BY grp) AS v, max(total) AS total, count(*)::DOUBLE AS n
  FROM (SELECT grp, held, (sum(held) OVER ())::DOUBLE AS total FROM sources WHERE held > 0)),
{bisect.format(name="be", test=entropy, steps=STEPS)},
{bisect.format(name="bl", test=limit, steps=STEPS)},
ex AS (SELECT greatest((SELECT a FROM be ORDER BY step DESC LIMIT 1), (SELECT a FROM bl ORDER BY step DESC LIMIT 1)) AS a),
size AS (SELECT a, {z} AS z, total, total * {z} * exp((1 - a) * list_max(v)) AS size FROM one, ex),
w AS (SELECT grp, docs, held, CASE WHEN held > 0 THEN exp(a * ln(held / total)) / z ELSE 0 END AS weight,
    CASE WHEN held > 0 THEN exp(a * ln(held / total)) / z * size ELSE 0 END AS share FROM sources, size),
m AS (SELECT *, CASE WHEN held = 0 THEN 1 ELSE floor(share / held + 1e-9) END::INTEGER AS "full",
    ceil(sqrt(docs))::BIGINT AS blocks FROM w),
m2 AS (SELECT *, greatest(floor(share - "full" * held + 1e-6)::BIGINT, 0) AS rest FROM m),
part AS (SELECT l.grp, tokens, rest, {partial} AS hash, {block.format(epoch='"full"')} AS block
  FROM light l JOIN m2 ON l.grp = m2.grp WHERE rest > 0),
sums AS (SELECT grp, rest, block, sum(tokens) AS held FROM part GROUP BY ALL),
run AS (SELECT *, coalesce(sum(held) OVER (PARTITION BY grp ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sums),
ends AS (SELECT grp, min(block) AS last_block, min(before) AS before FROM run WHERE before <= rest AND rest < before + held GROUP BY grp),
inside AS (SELECT p.grp, hash, rest, before, sum(tokens) OVER (PARTITION BY p.grp ORDER BY hash) AS upto
  FROM part p JOIN ends e ON p.grp = e.grp AND p.block = e.last_block),
last AS (SELECT grp, max(hash) AS last_hash FROM inside WHERE before + upto <= rest GROUP BY grp),
copies AS (SELECT doc_id, source, tokens, weight, epoch, {block.format(epoch="epoch")} AS block, {listed} AS hash,
    "full", last_block, last_hash
  FROM light l JOIN m2 ON l.grp = m2.grp LEFT JOIN ends ON l.grp = ends.grp LEFT JOIN last ON l.grp = last.grp,
    unnest(range("full" + 1)) AS u(epoch))
SELECT doc_id, source, tokens, round(weight, 9) AS weight, epoch::INTEGER AS epoch, block, hash FROM copies
WHERE epoch < "full" OR block < last_block OR (block = last_block AND hash <= last_hash)
"""


ORACLE_SQL = _oracle()
