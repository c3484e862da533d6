"""Mixing sources to target weights by hierarchical budgeting over a domain, language and source tree.

DataFrame and SQL expressions only. Each level has integer weights. The budget of a node is dealt to its
children by weight, but no child gets more than its subtree can supply, which is its tokens times the number
of epochs allowed; what one child cannot use goes to its siblings by weight, and only when all of them are full
does a shortage show at the level above, where it was dealt with in the same way. The split has a closed form:
children ordered by supply / weight, the first of them at which the level
``(budget - supplies of those before) / weights of those from here on`` is within reach sets the level for all.

A leaf's budget is spent on whole epochs and then on a prefix of the next one: documents in the order of a
seeded hash of (epoch, id), as far as the tokens reach. The prefix is found without sorting a leaf in one
place: the hash space is cut into SLOTS slots, tokens are added up per leaf and slot, and only the documents
of the slot in which the budget ends are ordered.

A document's tokens are its runs of characters other than space, tab, line feed and carriage return. Defined
results: null text has no tokens and is taken if the prefix passes its place and is not empty; null language or source is
the leaf value "none"; a weight that is not listed is 1; a weight of 0 or less excludes what is below it, whose
supply is then 0 and whose share goes to its siblings; an empty table gives an empty result. A very long text is one
document like others: it is taken if the prefix holds it whole. Rows that repeat an id and text take one place and
share their fate; places that tie in the hash are ordered by id. Rows without an id are one place. Columns besides
id, text, language and source are ignored; keep_mixed returns them all unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import free_name, materialize

SEED, SLOTS, MISSING = "mix-1", 4096, "none"
DOMAIN_WEIGHTS = {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}
LANGUAGE_WEIGHTS = {"en": 4, "fr": 2, "de": 2, "es": 1}
SOURCE_WEIGHTS = {"src0": 3, "src1": 2}
#: of all tokens there are, in hundredths
BUDGET_PERCENT, EPOCHS = 120, 3
LEVELS = ("domain", "language", "source")


def domain_of(source: Column, domains: dict[str, str] | None = None) -> Column:
    """The domain that the mapping names for a source (MISSING if it names none). Without a mapping the test tables'
    sources are dealt to four domains by the last character of their names."""
    if domains is not None:
        return _named(source, domains, MISSING)
    return F.concat(F.lit("domain"), F.pmod(F.ascii(F.substring(source, -1, 1)), F.lit(4)).cast("string"))


def _named(column: Column, values: dict, default) -> Column:
    """What a mapping holds for a name."""
    if not values:
        return F.lit(default)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in sorted(values.items()) for x in pair]), column), F.lit(default))


def _weight(column: str, weights: dict[str, int]) -> Column:
    return _named(F.col(column), weights, 1).cast("long")


def _turn(epoch: Column, seed: str) -> Column:
    """A place in [0, 2^32) from the seed, the epoch and the id."""
    word = F.concat(F.lit(seed), F.lit(":"), epoch.cast("string"), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long")


def leaves(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", domains: dict[str, str] | None = None) -> DataFrame:
    """doc_id, domain, language, source, n_tokens. domains: the domain of each source by name."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        domain_of(F.coalesce(F.col(source_col), F.lit(MISSING)), domains).alias("domain"),
        F.coalesce(F.col(lang_col), F.lit(MISSING)).alias("language"),
        F.coalesce(F.col(source_col), F.lit(MISSING)).alias("source"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit("[^ \\t\\n\\r]+")).cast("long").alias("n_tokens"),
    )


def _deal(children: DataFrame, parents: list[str], key: str) -> DataFrame:
    """children: parents, key, weight, supply, parent_budget. Adds budget.

    What comes before and after a child is added up without its siblings meeting in one task, since a node may have
    millions of them: children are ranged into parts by their order, parts are added up, and only the sums of parts
    are put in a row.
    """
    counts = F.col("weight") > 0
    parts = int(children.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = children.withColumn("ratio", F.when(counts, F.col("supply") / F.col("weight")).otherwise(float("inf"))).withColumn("own_weight", F.greatest("weight", F.lit(0)))
    ranged = materialize(own.repartitionByRange(parts, *parents, "ratio", key).withColumn("part", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy(*parents, "part").agg(F.sum("supply").alias("part_supply"), F.sum("own_weight").alias("part_weight"))
    by_part = Window.partitionBy(*parents).orderBy("part")
    before, after = by_part.rowsBetween(Window.unboundedPreceding, -1), by_part.rowsBetween(1, Window.unboundedFollowing)
    sums = sums.select(*parents, "part", F.coalesce(F.sum("part_supply").over(before), F.lit(0)).alias("before"), F.coalesce(F.sum("part_weight").over(after), F.lit(0)).alias("after"))
    within = Window.partitionBy(*parents, "part").orderBy("ratio", key)
    so_far, from_here = within.rowsBetween(Window.unboundedPreceding, -1), within.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    placed = ranged.withColumn("supply_before", F.coalesce(F.sum("supply").over(so_far), F.lit(0))).withColumn("weight_from", F.sum("own_weight").over(from_here)).join(sums, [*parents, "part"])
    level = (F.col("parent_budget") - F.col("before") - F.col("supply_before")) / (F.col("after") + F.col("weight_from"))
    reach = placed.withColumn("level", F.when(counts, level))
    # levels grow as long as they are out of reach, so the first within reach is the least of those within reach
    first = F.min(F.when(F.col("level") * F.col("weight") <= F.col("supply"), F.struct("ratio", key, "level"))).alias("water")
    reach = reach.join(reach.groupBy(*parents).agg(first), parents)
    share = F.when(~counts, 0).when(F.col("water").isNull(), F.col("supply")).otherwise(F.least(F.col("supply"), F.floor(F.col("water.level") * F.col("weight"))))
    return reach.withColumn("budget", share.cast("long")).select(*children.columns, "budget")


def budgets(own: DataFrame, weights: tuple[dict[str, int], ...] = (DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, SOURCE_WEIGHTS), percent: int = BUDGET_PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """domain, language, source, tokens, budget, whole (epochs), rest (tokens of the next epoch). own: leaves()."""
    open_ = F.lit(True)
    for key, weight in zip(LEVELS, weights, strict=True):
        open_ = open_ & (_weight(key, weight) > 0)
    leaf = own.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")).withColumn("supply", F.when(open_, F.col("tokens") * epochs).otherwise(0))
    leaf = leaf.withColumn("root", F.lit(0))
    path = ["root"]
    above = leaf.groupBy(*path).agg(F.floor(F.sum("tokens") * percent / 100).cast("long").alias("parent_budget"))
    for key, weight in zip(LEVELS, weights, strict=True):
        nodes = leaf.groupBy(*path, key).agg(F.sum("supply").alias("supply")).withColumn("weight", _weight(key, weight))
        dealt = _deal(nodes.join(above, path), path, key)
        path.append(key)
        above = dealt.select(*path, F.col("budget").alias("parent_budget"))
    leaf, above = leaf.drop("root"), above.drop("root")
    out = leaf.join(above.withColumnRenamed("parent_budget", "budget"), list(LEVELS))
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.greatest("tokens", F.lit(1)))).otherwise(0)
    return out.select(*LEVELS, "tokens", "budget", whole.cast("long").alias("whole")).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))


def select(docs: DataFrame, seed: str = SEED, weights: tuple[dict[str, int], ...] = (DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, SOURCE_WEIGHTS), percent: int = BUDGET_PERCENT, epochs: int = EPOCHS, **columns: str) -> DataFrame:
    """doc_id, domain, language, source, n_tokens, copies: how often each document is taken, 0 included."""
    own = materialize(leaves(docs, **columns), "leaves")  # texts are read once
    plan = materialize(budgets(own, weights, percent, epochs), "budgets")  # its size is known, so joins with it are broadcast only if small, else split
    named = own.join(plan.select(*LEVELS, "whole", "rest"), list(LEVELS))
    placed = named.withColumn("turn", _turn(F.col("whole"), seed)).withColumn("slot", F.shiftright("turn", 20).cast("int"))
    sums = placed.groupBy(*LEVELS, "slot").agg(F.sum("n_tokens").alias("slot_tokens"), F.first("rest").alias("rest"))
    until = F.sum("slot_tokens").over(Window.partitionBy(*LEVELS).orderBy("slot"))
    edge = sums.withColumn("until", until).where("until > rest").groupBy(*LEVELS).agg(F.min(F.struct("slot", (F.col("until") - F.col("slot_tokens")).alias("before"))).alias("e"))
    edge = edge.select(*LEVELS, F.col("e.slot").alias("edge_slot"), F.col("e.before").alias("before"))
    seen = placed.join(materialize(edge, "edges"), list(LEVELS), "left")
    out = [*("doc_id", "domain", "language", "source", "n_tokens")]
    apart = seen.where("slot is not distinct from edge_slot")
    order = Window.partitionBy(*LEVELS, "slot").orderBy("turn", "doc_id", "n_tokens").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reached = (F.col("rest") > 0) & (F.col("before") + F.sum("n_tokens").over(order) <= F.col("rest"))
    apart = apart.withColumn("copies", F.col("whole") + reached.cast("long")).select(*out, "copies")
    rest = seen.where("slot is distinct from edge_slot")
    rest = rest.withColumn("copies", F.col("whole") + ((F.col("rest") > 0) & F.coalesce(F.col("slot") < F.col("edge_slot"), F.lit(True))).cast("long")).select(*out, "copies")
    return rest.unionByName(apart)


def keep_mixed(docs: DataFrame, seed: str = SEED, percent: int = 90, id_col: str = "doc_id", **columns: str) -> DataFrame:
    """docs cut to ``percent`` hundredths of their tokens by the weights, each document at most once; columns unchanged."""
    mark = free_name(docs, "mixed_id")
    taken = select(docs, seed, percent=percent, epochs=1, id_col=id_col, **columns).where("copies > 0").select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(taken, docs[id_col].cast("long").eqNullSafe(F.col(mark)), "left_semi")


def sql(seed: str = SEED, percent: int = BUDGET_PERCENT, epochs: int = EPOCHS) -> str:
    """The same result in DuckDB SQL."""
    path: list[str] = []
    ctes, above = [], "(SELECT CAST(floor(coalesce(sum(tokens), 0) * %d / 100) AS BIGINT) AS parent_budget FROM leaf)" % percent
    for key, weights in zip(LEVELS, (DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, SOURCE_WEIGHTS), strict=True):
        case = "CASE " + key + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in sorted(weights.items())) + " ELSE 1 END"
        cols = ", ".join([*path, key])
        part = f"PARTITION BY {', '.join(path)}" if path else ""
        using = f"USING ({', '.join(path)})" if path else "ON true"
        ctes.append(f"""{key}_nodes AS (SELECT n.*, a.parent_budget, CAST({case} AS BIGINT) AS weight FROM (SELECT {cols}, CAST(sum(supply) AS BIGINT) AS supply FROM leaf GROUP BY {cols}) n JOIN {above} a {using}),
{key}_level AS (SELECT *, (parent_budget - coalesce(sum(supply) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / CAST(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM {key}_nodes WINDOW w AS ({part} ORDER BY supply / weight, {key})),
{key}_water AS (SELECT *, first_value(CASE WHEN level * weight <= supply THEN level END IGNORE NULLS) OVER ({part} ORDER BY supply / weight, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS water FROM {key}_level),
{key}_dealt AS (SELECT {cols}, CASE WHEN water IS NULL THEN supply ELSE least(supply, CAST(floor(water * weight) AS BIGINT)) END AS parent_budget FROM {key}_water)""")
        path.append(key)
        above = f"{key}_dealt"
    levels = ", ".join(LEVELS)
    return f"""WITH own AS (SELECT doc_id, 'domain' || (ascii(right(coalesce(source, '{MISSING}'), 1)) % 4) AS domain, coalesce(lang, '{MISSING}') AS language, coalesce(source, '{MISSING}') AS source,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) AS BIGINT) AS n_tokens FROM documents),
leaf AS (SELECT {levels}, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) * {epochs} AS BIGINT) AS supply FROM own GROUP BY {levels}),
{", ".join(ctes)},
plan AS (SELECT {levels}, tokens, parent_budget AS budget, CASE WHEN tokens > 0 THEN parent_budget // greatest(tokens, 1) ELSE 0 END AS whole FROM leaf JOIN source_dealt USING ({levels})),
placed AS (SELECT o.*, whole, budget - whole * p.tokens AS rest, CAST('0x' || substr(md5('{seed}:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS turn FROM own o JOIN plan p USING ({levels})),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {levels} ORDER BY turn, doc_id, n_tokens RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until FROM placed)
SELECT doc_id, domain, language, source, n_tokens, CAST(whole + CASE WHEN until <= rest AND rest > 0 THEN 1 ELSE 0 END AS BIGINT) AS copies FROM run"""
