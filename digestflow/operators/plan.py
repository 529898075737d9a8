"""Operators on plans: joins of selections with events and drafts, audits of order and quotas, swaps, ladders, ledgers and upgrades.

A plan is a relation selections(pos, event_id, tier, importance); a ladder is a ranked set of levels. All take relations and give relations; what
fills them (a judge, a planner, a run of the sources) is outside the engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TIERS = {"lead": 0, "follow": 1, "brief": 2}
LEVELS = {"L0": 0, "L1": 1, "L2A": 2, "L2B": 3, "L3": 4}


def rank_of(values: dict[str, int], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for p in values.items() for x in p]), key)


def judged(events: DataFrame, decisions: DataFrame) -> DataFrame:
    """Events with their decision; events without one are dropped (see unjudged)."""
    return events.join(decisions, "event_id")


def unjudged(events: DataFrame, decisions: DataFrame) -> DataFrame:
    return events.join(decisions, "event_id", "left_anti").select("event_id")


def planned(decided: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """(pos, event_id, tier, category, importance): the selected events by relevance, filled into the tiers in order; top-k before numbering."""
    best = decided.where("selected").orderBy(F.col("relevance").desc(), "event_id").limit(sum(sizes.values()))
    pos = F.row_number().over(W.orderBy(F.col("relevance").desc(), "event_id"))
    tier, upto = F.lit(None).cast("string"), 0
    for name, size in sizes.items():
        upto += size
        tier = F.coalesce(tier, F.when(F.col("pos") <= upto, name))
    return best.withColumn("pos", pos).select("pos", "event_id", tier.alias("tier"), "category", F.col("relevance").alias("importance"))


def composed(selections: DataFrame, events: DataFrame, drafts: DataFrame) -> DataFrame:
    """Selections with event and draft; a detail without a draft becomes a brief. drafts(event_id, tldr)."""
    joined = selections.join(events.select("event_id", "title", "summary"), "event_id").join(drafts, "event_id", "left")
    tier = F.when(F.col("tldr").isNull(), "brief").otherwise(F.col("tier"))
    plain = F.when(F.trim(F.coalesce("summary", F.lit(""))) != "", F.col("summary")).otherwise(F.col("title"))
    return joined.select("pos", "event_id", tier.alias("tier"), F.substring("title", 1, 100).alias("headline"), F.substring(F.coalesce("tldr", plain), 1, 240).alias("brief"))


def plan_counts(selections: DataFrame) -> DataFrame:
    """(tier, n, categories, least, most)."""
    return selections.groupBy("tier").agg(F.count("*").alias("n"), F.count_distinct("category").alias("categories"), F.min("importance").alias("least"), F.max("importance").alias("most"))


def order_violations(selections: DataFrame) -> DataFrame:
    """(pos, event_id, rule): places where a better tier follows a worse one, or importance rises within a tier."""
    by = W.orderBy("pos")  # a plan has a few dozen rows
    rank = rank_of(TIERS, F.col("tier"))
    before = selections.select("pos", "event_id", "tier", "importance", rank.alias("r"), F.lag(rank).over(by).alias("pr"), F.lag("importance").over(by).alias("pi"))
    rule = F.when(F.col("r") < F.col("pr"), "tier").when((F.col("r") == F.col("pr")) & (F.col("importance") > F.col("pi")), "importance")
    return before.select("pos", "event_id", rule.alias("rule")).where("rule is not null")


def quota_violations(selections: DataFrame, quotas: dict[str, tuple[int, int]]) -> DataFrame:
    """(tier, n, least, most): tiers whose size lies outside its quota, tiers without rows included."""
    asked = selections.sparkSession.createDataFrame([(t, lo, hi) for t, (lo, hi) in quotas.items()], "tier string, least int, most int")
    counted = selections.groupBy("tier").agg(F.count("*").alias("n"))
    return asked.join(counted, "tier", "left").select("tier", F.coalesce("n", F.lit(0)).alias("n"), "least", "most").where("n < least or n > most")


def evidence_violations(claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """(rule, event_id, n): claims on unknown events, on evidence that is not the event's, and the same place claimed twice."""
    owned = evidence.select(F.col("evidence_id").alias("_id"), F.col("event_id").alias("_owner")).dropDuplicates(["_id"])
    events = evidence.select(F.col("event_id").alias("_e")).distinct()
    joined = claims.join(owned, F.col("evidence_id") == F.col("_id"), "left").join(events, F.col("event_id") == F.col("_e"), "left")
    rule = F.when(F.col("_e").isNull(), "unknown event").when(F.col("_id").isNull() | (F.col("_owner") != F.col("event_id")), "foreign evidence")
    single = joined.select(rule.alias("rule"), "event_id").where("rule is not null").groupBy("rule", "event_id").agg(F.count("*").alias("n"))
    twice = claims.groupBy("event_id", "pos").agg(F.count("*").alias("n")).where("n > 1").groupBy("event_id").agg(F.sum("n").alias("n"))
    return single.unionByName(twice.select(F.lit("place taken").alias("rule"), "event_id", "n"))


def swapped_leads(selections: DataFrame, qualified: DataFrame) -> DataFrame:
    """Selections in which the i-th unqualified lead has changed tiers with the i-th qualified follow; unqualified leads beyond are follows. qualified(event_id, qualified)."""
    marked = selections.join(qualified, "event_id", "left").withColumn("ok", F.coalesce("qualified", F.lit(False)))
    turn = F.when((F.col("tier") == "lead") & ~F.col("ok"), "out").when((F.col("tier") == "follow") & F.col("ok"), "in")
    numbered = marked.withColumn("turn", turn).withColumn("i", F.row_number().over(W.partitionBy("turn").orderBy("pos")))
    outs = numbered.agg(F.count_if(F.col("turn") == "out").alias("outs"))
    tier = F.when(F.col("turn") == "out", "follow").when((F.col("turn") == "in") & (F.col("i") <= F.col("outs")), "lead").otherwise(F.col("tier"))
    moved = numbered.crossJoin(F.broadcast(outs)).select("event_id", tier.alias("tier"), "category", "importance", (tier != F.col("tier")).alias("moved"))
    place = F.row_number().over(W.orderBy(rank_of(TIERS, F.col("tier")), F.col("importance").desc(), "event_id"))
    return moved.select(place.alias("pos"), "event_id", "tier", "importance", "moved")


def repaired_details(selections: DataFrame, passed: DataFrame, sizes: int = 64) -> DataFrame:
    """Selections after exchanging failing details for briefs until all details pass or no exchange helps; passed(event_id, passed).

    A fixpoint over one plan of at most `sizes` rows, checked, on the driver; the first failing detail takes the most important brief that passes.
    """
    rows = selections.join(passed, "event_id", "left").orderBy("pos").limit(sizes + 1).collect()
    if len(rows) > sizes:
        raise ValueError(f"a plan holds at most {sizes} rows")
    tier, ok = {r.event_id: r.tier for r in rows}, {r.event_id: bool(r.passed) for r in rows}
    briefs = [r.event_id for r in sorted(rows, key=lambda r: (-r.importance, r.pos)) if r.tier == "brief" and ok[r.event_id]]
    for r in rows:
        if r.tier != "brief" and not ok[r.event_id] and briefs:
            other = briefs.pop(0)
            tier[other], tier[r.event_id] = r.tier, "brief"
    out = sorted(rows, key=lambda r: (TIERS[tier[r.event_id]], -r.importance, r.event_id))
    return selections.sparkSession.createDataFrame([(i, r.event_id, tier[r.event_id], tier[r.event_id] != r.tier) for i, r in enumerate(out, 1)], "pos int, event_id string, tier string, moved boolean")


def highlight(selections: DataFrame, titles: DataFrame, limit: int = 300) -> DataFrame:
    """One row: the first lead headlines in one line, four if they fit, else three cut at the limit."""
    lead = selections.where("tier = 'lead'").join(titles, "event_id").select("pos", F.substring("title", 1, 100).alias("h"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("pos", "h"))), lambda x: x["h"])  # one plan
    line = lambda n: F.array_join(F.slice("hs", 1, n), "；")
    return lead.agg(parts.alias("hs")).select(F.when(F.length(line(4)) <= limit, line(4)).otherwise(F.trim(F.substring(line(3), 1, limit))).alias("highlight"))


def ladder(failures: DataFrame, ceilings: dict[str, str]) -> DataFrame:
    """(scope, level, blocked, reasons) from failures(scope, seq, failure, detail): the worst ceiling of any failure; of each class the first detail counts, in order of record."""
    order = F.struct("seq", "detail")
    first = failures.groupBy("scope", "failure").agg(F.min(order).alias("f"))
    ranked = first.withColumn("r", F.coalesce(rank_of({k: LEVELS[v] for k, v in ceilings.items()}, F.col("failure")), F.lit(0)))
    folded = ranked.groupBy("scope").agg(F.max("r").alias("r"), F.sort_array(F.collect_list(F.struct(F.col("f.seq").alias("seq"), F.concat_ws(": ", "failure", F.substring("f.detail", 1, 500)).alias("t")))).alias("all"))  # as many as classes
    level = F.element_at(F.array(*[F.lit(name) for name in LEVELS]), F.col("r") + 1)
    return folded.select("scope", level.alias("level"), (F.col("r") == LEVELS["L3"]).alias("blocked"), F.array_join(F.transform("all", lambda x: x["t"]), " | ").alias("reasons"))


def ledger(spends: DataFrame, limit: float) -> DataFrame:
    """(day, stage, seq, amount, day_total, stage_total, over) from spends(day, stage, seq, amount): running totals, and whether the row is the first beyond the day's limit. Days are ordered apart from each other."""
    day = W.partitionBy("day").orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    stage = W.partitionBy("day", "stage").orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    total = F.sum("amount").over(day)
    run = spends.select("day", "stage", "seq", "amount", total.alias("day_total"), F.sum("amount").over(stage).alias("stage_total"))
    return run.withColumn("over", (F.col("day_total") > limit) & (F.col("day_total") - F.col("amount") <= limit))


def allowances(spends: DataFrame, shares: dict[str, float], limit: int) -> DataFrame:
    """(day, stage, used, allowance): what each stage may still spend: its share of the day's limit less what it used, at most what the day has left."""
    asked = spends.sparkSession.createDataFrame([(s, int(limit * share)) for s, share in shares.items()], "stage string, part int")
    used = spends.groupBy("day", "stage").agg(F.count("*").alias("used"))
    days = spends.groupBy("day").agg(F.count("*").alias("all_used"))
    joined = days.crossJoin(F.broadcast(asked)).join(used, ["day", "stage"], "left")  # stages beside days
    return joined.select("day", "stage", F.coalesce("used", F.lit(0)).alias("used"), F.greatest(F.lit(0), F.least(F.col("part") - F.coalesce("used", F.lit(0)), F.lit(limit) - F.col("all_used"))).alias("allowance"))


def upgrades(versions: DataFrame) -> DataFrame:
    """(key, seq, level) of versions(key, seq, level) that are strictly better than every one before: what an upgrade-only store would have accepted."""
    rank = rank_of(LEVELS, F.col("level"))
    best = F.min(rank).over(W.partitionBy("key").orderBy("seq").rowsBetween(W.unboundedPreceding, -1))
    return versions.withColumn("_r", rank).withColumn("_b", best).where("_b is null or _r < _b").select("key", "seq", "level")


def replaced(history: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """History with the rows of current in place of its own of the same key."""
    return history.join(current.select(key).distinct(), key, "left_anti").unionByName(current.select(history.columns))


def recommended(scores: DataFrame, lead: float) -> DataFrame:
    """(profile, score, place, ahead, recommended): eligible profiles by score; the first is recommended if it leads by at least `lead`."""
    order = W.orderBy(F.col("score").desc(), "profile")  # one row for each profile
    ahead = F.col("score") - F.lead("score").over(order)
    return scores.where("eligible").select("profile", "score", F.row_number().over(order).alias("place"), F.round(ahead, 6).alias("ahead"), ((F.row_number().over(order) == 1) & (F.coalesce(ahead, F.lit(lead)) >= lead)).alias("recommended"))


def retained(releases: DataFrame, active: str, keep: int = 30) -> DataFrame:
    """(name, kept) of releases(name): the newest `keep` and the active one."""
    newest = releases.orderBy(F.col("name").desc()).limit(keep).select("name", F.lit(True).alias("_new"))
    return releases.join(newest, "name", "left").select("name", F.coalesce(F.col("_new"), F.lit(False)) | (F.col("name") == active)).toDF("name", "kept")


def longest(rows: DataFrame, key: str, text: str, *ties: str) -> DataFrame:
    """The longest text of each key, ties by the named columns: one aggregation."""
    order = F.struct((-F.length(F.coalesce(text, F.lit("")))).alias("l"), *[F.col(t) for t in ties])
    return rows.groupBy(key).agg(F.min_by(F.struct(*ties, F.length(F.coalesce(text, F.lit(""))).alias("size")), order).alias("_b")).select(key, "_b.*")
