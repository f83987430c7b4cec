"""M1, M3 and M11: the fitted coefficients are optimal on all training rows, by the conditions on the gradient."""

from pyspark.sql import functions as F

from fieldtally.operators import train
from fieldtally.operators.certificate import certificate
from fieldtally.operators.sampling import random_split
from fieldtally.plans import jobs
from fieldtally.queries.columns import checklist_plan
from fieldtally.queries.models import frames
from fieldtally.queries.registry import query, sql_hash
from fieldtally.queries.tables import WITH_OBS, checklist
from fieldtally.session import fresh_folder

# The documented penalties, written again so that the twin fails if a trainer's differ.
L1 = 0.005
WEAK = 1e5

_DRAW = sql_hash("'balance'", "event_id")
# The training part, without secondary checklists that saw nothing, half of its zeros and missing ones kept.
_TRAINED = f"""{sql_hash("'345'", 'event_id')} < 3435973837 AND (primary_flag = '1' OR target_raw NOT IN ('0', '?'))
    AND (target_raw NOT IN ('0', '?') OR {_DRAW} < 2147483648)"""


def _twin(first):
    width = checklist_plan().width
    return f"""{WITH_OBS} SELECT CAST(p AS INT) AS pos, n, true AS optimal
        FROM (SELECT count(*) AS n FROM obs WHERE {_TRAINED}) AS t CROSS JOIN range({first}, {width}) AS r(p)"""


def _checked(training, model, **penalty):
    found = certificate(training, model.coefficients.toArray(), model.intercept, **penalty)
    return found.select("pos", "n", "optimal")


@query("m1_logistic_l1_optimal", _twin(0))
def logistic_l1_optimal(spark, d):
    _, training, _ = frames(spark, d)
    model = train.fit_kind("logistic_l1", training).stages[-1]
    return _checked(training, model, l1=L1, fit_intercept=False)


@query("m3_logistic_weak_l2_optimal", _twin(-1))
def logistic_weak_l2_optimal(spark, d):
    _, training, _ = frames(spark, d)
    model = train.fit_kind("weak_l2", training).stages[-1]
    return _checked(training, model, l2=1.0 / (WEAK * training.count()), standardized=False)


@query("m11_train_job_optimal", _twin(0))
def train_job_optimal(spark, d):
    """Raw rows to saved model; what is loaded again is optimal on the rows that the job had to train on."""
    plan = checklist_plan()
    raw = random_split(checklist(spark, d), plan.key(), jobs.SPLIT, jobs.SPLIT_SEED).filter(F.col("split") == "train")
    path = fresh_folder(spark, "model")
    jobs.save_model(spark, jobs.train(raw, plan), plan, path)
    model, _ = jobs.load_model(spark, path)
    return _checked(jobs.training_frame(raw, plan), model.stages[-1], l1=L1, fit_intercept=False)
