"""M, P and model files: training, scoring, ensembles.

Trainers are checked on row counts and metrics; what is arithmetic (closed-form fits, votes, thresholds, round
trips) has an exact SQL twin. All run with the library's default parameters.
"""

from pyspark.sql import functions as F

from fieldtally.operators import shards, train, vote
from fieldtally.operators.boost import fit_adaboost
from fieldtally.operators.engineer import LABEL_META, sparse_vector
from fieldtally.operators.evaluate import auc_roc, confusion_accuracy
from fieldtally.operators.order import cache_input, zip_index
from fieldtally.operators.sampling import class_balance, random_split
from fieldtally.operators.score import score_test, score_validation, with_score
from fieldtally.plans import jobs
from fieldtally.queries.columns import checklist_plan
from fieldtally.queries.registry import query, r6, sql_r6
from fieldtally.queries.tables import WITH_OBS, dealt_checklist, obs, table
from fieldtally.session import fresh_folder, materialize

def frames(spark, d):
    """(plan, cached balanced training part, validation part), cleaned in the tasks they are dealt to."""
    plan = checklist_plan()
    parts = random_split(dealt_checklist(spark, d), plan.key(), jobs.SPLIT, jobs.SPLIT_SEED)
    rows = class_balance(plan.select_rows(parts.filter("split = 'train'")), plan.target(), plan.key())
    return plan, cache_input(plan.transform(rows)), plan.transform(parts.filter("split = 'validation'"))


def report(spark, model, plan, validation, kind):
    """One row: kind, confusion counts, accuracy, area under the curve."""
    scored = cache_input(score_validation(model, validation, plan.spec.key))
    try:
        area = auc_roc(scored)
        row = confusion_accuracy(scored).first()
    finally:
        scored.unpersist()
    result = [(kind, row.true_pos, row.true_neg, row.false_pos, row.false_neg, row.total, round(row.accuracy, 6), round(area, 6))]
    return spark.createDataFrame(
        result,
        "kind string, true_pos long, true_neg long, false_pos long, false_neg long, total long, accuracy double, auc double",
    )


def _fit_and_report(spark, d, kind):
    plan, training, validation = frames(spark, d)
    try:
        model = train.fit_kind(kind, training)
    finally:
        training.unpersist()
    return report(spark, model, plan, validation, kind)


for _id, _kind in {
    "m1_fit_logistic_l1": "logistic_l1",
    "m2_fit_random_forest": "random_forest",
    "m2_fit_random_forest_deep": "deep_forest",
    "m3_fit_logistic_weak_l2": "weak_l2",
    "m4_fit_weighted_forest": "weighted_forest",
    "m5_fit_gbt": "gbt",
    "m6_fit_adaboost": "adaboost",
    "m7_fit_mlp": "mlp",
}.items():
    query(_id)(lambda spark, d, kind=_kind: _fit_and_report(spark, d, kind))


_RULE_SQL = """SELECT cat, CAST(CASE WHEN cat IN (1, 2) THEN 1 ELSE 0 END AS INT) AS prediction, count(*) AS rows
    FROM (SELECT CAST((l_orderkey % 2) * 2 + l_linenumber % 2 AS INT) AS cat FROM lineitem) AS c GROUP BY cat"""


def _fit_the_rule(spark, d, kind):
    """All order lines, labelled by a fixed rule of a category, which the fitted model has to give back for each row."""
    cat = ((F.col("l_orderkey") % 2) * 2 + F.col("l_linenumber") % 2).cast("int")
    flags = F.array(*[(F.col("cat") == k).cast("double") for k in range(4)])
    line = ["l_orderkey", "l_linenumber"]
    rows = table(spark, d, "lineitem").select(*line, cat.alias("cat"), (F.col("l_orderkey") % 3).alias("shard"))
    rows = rows.select(*line, "cat", "shard", F.col("cat").isin(1, 2).cast("double").alias("label", metadata=LABEL_META), flags.alias("flags"))
    training = jobs.spread(sparse_vector(rows, "flags", 4).drop("flags"), *line)
    try:
        if kind == "sharded_forest":
            model = shards.fit_sharded_forest(training, [0, 1, 2])
        else:
            model = train.fit_kind(kind, training)
        result = with_score(model, training).groupBy("cat", "prediction").agg(F.count(F.lit(1)).alias("rows")).collect()  # a few categories
    finally:
        training.unpersist()
    return spark.createDataFrame(result, "cat int, prediction int, rows long")


for _id, _kind in {
    "m1_rule_logistic_l1": "logistic_l1",
    "m2_rule_random_forest": "random_forest",
    "m2_rule_deep_forest": "deep_forest",
    "m3_rule_weak_l2": "weak_l2",
    "m4_rule_weighted_forest": "weighted_forest",
    "m5_rule_gbt": "gbt",
    "m7_rule_mlp": "mlp",
    "m10_rule_sharded_forest": "sharded_forest",
}.items():
    query(_id, _RULE_SQL)(lambda spark, d, kind=_kind: _fit_the_rule(spark, d, kind))


@query("m6_adaboost_rounds")
def adaboost_rounds(spark, d):
    """Error, alpha and weight total of each boosting round."""
    _, training, _ = frames(spark, d)
    history = []
    try:
        fit_adaboost(training, history=history)
    finally:
        training.unpersist()
    rows = [(h["round"], round(h["error"], 6), round(h["alpha"], 6), round(h["total"], 6)) for h in history]
    return spark.createDataFrame(rows, "round int, error double, alpha double, total double")


@query("m8_fit_ensemble")
def fit_ensemble(spark, d):
    plan, training, validation = frames(spark, d)
    try:
        model = train.fit_ensemble(training, train.ENSEMBLE)
    finally:
        training.unpersist()
    return report(spark, model, plan, validation, "ensemble")


LINEAR = ["lat", "lon", "month"]
_MOMENTS = ", ".join(
    [f"avg({c}) AS m{i}" for i, c in enumerate(LINEAR)]
    + [f"covar_pop({LINEAR[i]}, {LINEAR[j]}) AS s{i}{j}" for i in range(3) for j in range(i, 3)]
    + [f"covar_pop({c}, value) AS t{i}" for i, c in enumerate(LINEAR)]
)
_DET = "(s00 * (s11 * s22 - s12 * s12) - s01 * (s01 * s22 - s12 * s02) + s02 * (s01 * s12 - s11 * s02))"
_SLOPES = [
    "(t0 * (s11 * s22 - s12 * s12) - s01 * (t1 * s22 - s12 * t2) + s02 * (t1 * s12 - s11 * t2))",
    "(s00 * (t1 * s22 - s12 * t2) - t0 * (s01 * s22 - s12 * s02) + s02 * (s01 * t2 - t1 * s02))",
    "(s00 * (s11 * t2 - t1 * s12) - s01 * (s01 * t2 - t1 * s02) + t0 * (s01 * s12 - s11 * s02))",
]
WITH_SHARDS = f"""{WITH_OBS}, moments AS (SELECT event_id % 4 AS shard, count(*) AS n, avg(value) AS my, {_MOMENTS} FROM obs GROUP BY event_id % 4),
    solved AS (SELECT *, {', '.join(f'{s} / {_DET} AS b{k}' for k, s in enumerate(_SLOPES))} FROM moments),
    fitted AS (SELECT shard, n, my - b0 * m0 - b1 * m1 - b2 * m2 AS intercept, b0, b1, b2 FROM solved)"""
COEFFICIENTS = ["intercept", "b0", "b1", "b2"]


def _fitted(spark, d):
    return shards.fit_sharded_linear(obs(spark, d), F.col("event_id") % 4, LINEAR, "value")


@query("m9_fit_sharded_linear", f"{WITH_SHARDS} SELECT shard, n, {', '.join(f'{sql_r6(c)} AS {c}' for c in COEFFICIENTS)} FROM fitted")
def fit_sharded_linear(spark, d):
    return _fitted(spark, d).select("shard", "n", *[r6(F.col(c)).alias(c) for c in COEFFICIENTS])


@query("m10_fit_sharded_forest")
def fit_sharded_forest(spark, d):
    """Ten trees for each of two shards, scored by the mean of the shard models."""
    plan, training, validation = frames(spark, d)
    sharded = training.withColumn("shard", shards.shard_of(F.col(plan.spec.key), 2))  # over the cached rows
    try:
        model = shards.fit_sharded_forest(sharded, [0, 1])
    finally:
        training.unpersist()
    return report(spark, model, plan, validation, "sharded_forest")


@query("m11_train_job")
def train_job(spark, d):
    """Raw rows to saved model, reloaded and reported."""
    plan = checklist_plan()
    parts = random_split(dealt_checklist(spark, d), plan.key(), jobs.SPLIT, jobs.SPLIT_SEED)
    path = fresh_folder(spark, "model")
    jobs.save_model(spark, jobs.train(parts.filter("split = 'train'"), plan), plan, path)
    model, spec = jobs.load_model(spark, path)
    assert spec == plan.spec
    return report(spark, model, plan, plan.transform(parts.filter("split = 'validation'")), "train_job")


def _agreement(spark, validation, key, before, after):
    """Rows scored by both models, and on how many they differ."""
    both = with_score(before, validation).withColumnsRenamed({"score": "score_before", "prediction": "before"})
    both = with_score(after, both)
    return both.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if((F.col("before") != F.col("prediction")) | (F.col("score_before") != F.col("score"))).alias("differ"),
    )


_VALIDATION = """CAST(('0x' || substr(md5(concat('345', ':', CAST(event_id AS VARCHAR))), 1, 8)) AS BIGINT) >= 3435973837"""
_AGREEMENT_SQL = f"SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differ FROM events WHERE {_VALIDATION}"


@query("s9_save_load_model", _AGREEMENT_SQL)
def save_load_model(spark, d):
    """A loaded model scores every row as the saved one did."""
    plan, training, validation = frames(spark, d)
    try:
        model = train.fit_kind("logistic_l1", training)
    finally:
        training.unpersist()
    path = fresh_folder(spark, "model")
    jobs.save_model(spark, model, plan, path)
    loaded, _ = jobs.load_model(spark, path)
    return _agreement(spark, validation, plan.spec.key, model, loaded)


@query("s10_save_load_ensemble", _AGREEMENT_SQL)
def save_load_ensemble(spark, d):
    plan, training, validation = frames(spark, d)
    try:
        model = train.fit_ensemble(training, ("logistic_l1", "random_forest", "adaboost"))
    finally:
        training.unpersist()
    path = fresh_folder(spark, "ensemble")
    jobs.save_model(spark, model, plan, path)
    loaded, _ = jobs.load_model(spark, path, vote=True)
    return _agreement(spark, validation, plan.spec.key, model, loaded)


@query("p1_score_test")
def score_test_query(spark, d):
    """Unlabelled rows numbered, scored and put in input order under the submission header."""
    plan, training, _ = frames(spark, d)
    try:
        model = train.fit_kind("logistic_l1", training)
    finally:
        training.unpersist()
    # Score first: two narrow columns are numbered and sorted, not the raw record.
    scored = score_test(model, plan.transform(dealt_checklist(spark, d), labelled=False), plan.spec.key)
    order = F.col(plan.spec.key).cast("bigint").alias("order")
    numbered = zip_index(materialize(scored.select(order, "*"), "scored"), "order")
    return numbered.orderBy("index").select(
        "index", plan.spec.key, F.col("prediction").alias("SAW_AGELAIUS_PHOENICEUS")
    )


@query("p2_score_validation")
def score_validation_query(spark, d):
    plan, training, validation = frames(spark, d)
    try:
        model = train.fit_kind("random_forest", training)
    finally:
        training.unpersist()
    return score_validation(model, validation, plan.spec.key).select(plan.spec.key, "label", "prediction")


_RULES = ["value > 50", "sp2_raw <> '0'", "month <= 6"]


@query(
    "p3_ensemble_vote",
    f"""{WITH_OBS} SELECT event_id, {sql_r6('(' + ' + '.join(f'CASE WHEN {r} THEN 1 ELSE 0 END' for r in _RULES) + ') / 3.0')} AS score,
        CASE WHEN {' + '.join(f'CASE WHEN {r} THEN 1 ELSE 0 END' for r in _RULES)} > 1.5 THEN 1 ELSE 0 END AS prediction FROM obs""",
)
def ensemble_vote(spark, d):
    """The vote's arithmetic on three fixed rules as members."""
    members = [F.expr(f"CASE WHEN {r} THEN 1 ELSE 0 END") for r in _RULES]
    return obs(spark, d).select(
        "event_id", r6(vote.mean_score(members)).alias("score"), vote.vote(members).alias("prediction")
    )


@query("p3_ensemble_vote_models")
def ensemble_vote_models(spark, d):
    plan, training, validation = frames(spark, d)
    try:
        model = train.fit_ensemble(training, ("logistic_l1", "random_forest", "weak_l2"))
    finally:
        training.unpersist()
    return score_validation(model, validation, plan.spec.key)


@query("p4_threshold", "SELECT event_id, CASE WHEN value / 100 > 0.5 THEN 1 ELSE 0 END AS prediction FROM events")
def threshold(spark, d):
    return table(spark, d, "events").select("event_id", vote.threshold(F.col("value") / 100).alias("prediction"))


@query(
    "p5_ensemble_mean",
    f"""{WITH_SHARDS}, mean AS (SELECT {', '.join(f'avg({c}) AS {c}' for c in COEFFICIENTS)} FROM fitted)
        SELECT event_id, {sql_r6('intercept + b0 * lat + b1 * lon + b2 * month')} AS prediction FROM obs CROSS JOIN mean""",
)
def ensemble_mean(spark, d):
    predicted = shards.mean_linear_prediction(obs(spark, d), _fitted(spark, d), LINEAR)
    return predicted.select("event_id", r6(F.col("prediction")).alias("prediction"))


@query("p5_ensemble_mean_forest")
def ensemble_mean_forest(spark, d):
    """Unthresholded mean of shard forests on the line table."""
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    rows = table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
        F.array(*columns).alias("values"),
    )
    cleaned = sparse_vector(rows, "values", 3).drop("values")
    sharded = cache_input(cleaned.withColumn("shard", shards.shard_of(F.col("id"), 2)).drop("id"))  # fits read no identifiers
    try:
        model = shards.fit_sharded_forest(sharded, [0, 1])
    finally:
        sharded.unpersist()
    return model.transform(cleaned).select("id", "score")


@query("p6_broadcast_coefficients", f"{WITH_SHARDS} SELECT event_id, {sql_r6('intercept + b0 * lat + b1 * lon + b2 * month')} AS prediction FROM obs JOIN fitted ON event_id % 4 = shard")
def broadcast_coefficients(spark, d):
    """Each row under its own shard's model; the shard table is small, and adaptive execution sees that."""
    rows = obs(spark, d).withColumn("shard", F.col("event_id") % 4)
    joined = rows.join(_fitted(spark, d), "shard")
    total = F.col("intercept") + F.col("b0") * F.col("lat") + F.col("b1") * F.col("lon") + F.col("b2") * F.col("month")
    return joined.select("event_id", r6(total).alias("prediction"))
