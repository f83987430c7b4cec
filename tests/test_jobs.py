"""The wide file from text to submission."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtally.operators.evaluate import confusion_accuracy
from fieldtally.plans import jobs
from fieldtally.plans.record import RecordSpec
from fieldtally.queries.tables import wide_header, wide_lines
from fieldtally.sources.text import count_records, read_wide


@pytest.fixture(scope="module")
def wide_path(spark, sf, tmp_path_factory):
    """One plain and one bzip2 file of 1,000 rows with a header."""
    lines = sorted((r.value for r in wide_lines(spark, sf).collect()), key=lambda v: int(v.split(",")[0][1:]))
    text = "\n".join([",".join(wide_header()), *lines]) + "\n"
    folder = tmp_path_factory.mktemp("wide")
    (folder / "plain.csv").write_text(text)
    import bz2

    (folder / "packed.csv.bz2").write_bytes(bz2.compress(text.encode()))
    return folder


def test_read_wide(spark, wide_path):
    raw, cells = read_wide(spark, str(wide_path / "plain.csv"))
    assert len(cells.catalog) == 1657 and raw.count() == 1000
    packed, _ = read_wide(spark, str(wide_path / "packed.csv.bz2"))
    assert raw.exceptAll(packed).count() == 0
    assert count_records(spark, str(wide_path / "packed.csv.bz2")) == 1001


def test_pruned_split_keeps_the_features(spark, wide_path):
    frames = []
    for needed in (None, wide_header()[-1:]):
        raw, cells = read_wide(spark, str(wide_path / "plain.csv"), needed=needed)
        plan = jobs.RecordPlan(RecordSpec(), cells)
        frames.append(plan.to_arrays(raw))
    assert frames[0].exceptAll(frames[1]).count() == 0
    assert frames[0].select(F.size("values")).distinct().collect()[0][0] == 995


def test_filters_cut_only_the_head(spark, wide_path):
    """Filters pushed below the projection must not cut whole lines."""
    raw, plan = jobs.open_wide(spark, str(wide_path / "plain.csv"))
    text = jobs.training_frame(raw, plan)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count(f", {plan.last_position() + 2})") == 1


def test_features_against_plain_python(spark, wide_path):
    raw, plan = jobs.open_wide(spark, str(wide_path / "plain.csv"))
    rows = plan.to_arrays(raw).orderBy("SAMPLING_EVENT_ID").limit(40).collect()
    header, names = wide_header(), plan.feature_names
    lines = {v.split(",")[0]: v.split(",") for v in (wide_path / "plain.csv").read_text().splitlines()[1:]}
    first = {}
    for i, n in enumerate(header):
        first.setdefault(n, i)
    for row in rows:
        cells, got = lines[row.SAMPLING_EVENT_ID], dict(zip(names, row["values"], strict=True))
        target = cells[26]
        assert row.label == (1.0 if target == "x" or target not in ("0", "?") else 0.0)
        for name in ("Genus_species19", "Genus_species952", "POP00_SQMI", "MONTH"):
            cell = cells[first[name]]
            want = {"?": {0.0}, "x": set(range(2, 11))}.get(cell) or {float(cell)}
            assert got[name] in want
        for name in ("CAUS_PREC", "CAUS_SNOW", "CAUS_TEMP_MIN"):
            cell = cells[first[name]]
            if cell == "?":
                sibling = f"{name}{int(cells[5]):02d}"
                cell = cells[first[sibling]] if sibling in first else "0"
            assert got[name] == (0.0 if cell == "?" else float(cell))
        lat, lon = np.radians(float(cells[2])), np.radians(float(cells[3]))
        assert got["geo_x"] == pytest.approx(6371 * np.cos(lat) * np.cos(lon))
        assert sum(v for n, v in got.items() if n.startswith("protocol_")) == (cells[11] != "P99")


def test_train_score_validate(spark, wide_path, tmp_path):
    source, model, out = str(wide_path / "plain.csv"), str(tmp_path / "model"), str(tmp_path / "out")
    jobs.train_job(spark, source, model)
    jobs.score_job(spark, source, model, out, single_file=True)
    lines = next((tmp_path / "out").glob("part-*")).read_text().splitlines()
    assert lines[0] == "SAMPLING_EVENT_ID,SAW_AGELAIUS_PHOENICEUS"
    given = [v.split(",")[0] for v in (wide_path / "plain.csv").read_text().splitlines()[1:]]
    assert [v.split(",")[0] for v in lines[1:]] == given
    assert {v.split(",")[1] for v in lines[1:]} <= {"0", "1"}

    jobs.validation_job(spark, source, model, str(tmp_path / "validation"))
    accuracy = jobs.accuracy_job(spark, str(tmp_path / "validation")).first()
    assert accuracy.total == 1000 and accuracy.accuracy > 0.5


def test_ensemble(spark, wide_path, tmp_path):
    source, model = str(wide_path / "plain.csv"), str(tmp_path / "model")
    jobs.ensemble_job(spark, source, model, ("logistic_l1", "weak_l2"))
    jobs.validation_job(spark, source, model, str(tmp_path / "out"), vote=True)
    assert jobs.accuracy_job(spark, str(tmp_path / "out")).first().total == 1000


def test_combined(spark, wide_path, tmp_path):
    paths = [str(tmp_path / n) for n in ("validation", "model", "predictions")]
    row = jobs.combined_job(spark, str(wide_path / "packed.csv.bz2"), *paths).first()
    assert row.total == spark.read.text(paths[0]).count() > 100
    lines = spark.read.text(paths[0]).select(F.size(F.split("value", ",")).alias("n")).distinct().collect()
    assert [r.n for r in lines] == [1657]


def test_profile_and_sample(spark, wide_path, tmp_path):
    row = jobs.profile_job(spark, str(wide_path / "plain.csv")).first()
    assert row.total == 1000 == row.zeros + row.ones + row.missing + row.extra
    jobs.sample_job(spark, str(wide_path / "plain.csv"), str(tmp_path / "sample"))
    sample = {r.value for r in spark.read.text(str(tmp_path / "sample")).collect()}
    assert 0 < len(sample) < 40 and sample < set((wide_path / "plain.csv").read_text().splitlines())


def test_correlation(spark, wide_path, tmp_path):
    paths = str(tmp_path / "matrix"), str(tmp_path / "pairs")
    jobs.correlation_job(spark, str(wide_path / "plain.csv"), *paths)
    matrix = spark.read.parquet(paths[0])
    assert matrix.count() == 996**2
    pairs = spark.read.csv(paths[1], header=True, schema="name string, r double")
    assert pairs.count() == 933
    raw, plan = jobs.open_wide(spark, str(wide_path / "plain.csv"))
    arrays = plan.to_arrays(raw).toPandas()
    values = np.array(arrays["values"].tolist())
    index = {n: i for i, n in enumerate(plan.feature_names)}
    for r in pairs.limit(30).collect():
        column = values[:, index[r.name]]
        if column.std() > 0:
            assert r.r == pytest.approx(np.corrcoef(arrays.label, column)[0, 1])


def test_steps_accept_a_stream(spark, wide_path, tmp_path):
    """The record steps hold no state and no aggregate, so a streaming frame passes through them unchanged."""
    raw, plan = jobs.open_wide(spark, str(wide_path / "plain.csv"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part.csv").write_text("\n".join((wide_path / "plain.csv").read_text().splitlines()[1:51]))
    from fieldtally.sources.text import split_cells

    lines = spark.readStream.text(str(tmp_path / "in"))
    query = (
        plan.to_arrays(split_cells(lines, upto=1101, head_upto=26))
        .writeStream.format("memory").queryName("streamed").option("checkpointLocation", str(tmp_path / "check")).start()
    )
    query.processAllAvailable()
    query.stop()
    streamed = spark.table("streamed")
    assert streamed.count() == 50
    assert streamed.exceptAll(plan.to_arrays(raw)).count() == 0
    assert confusion_accuracy(streamed.withColumn("prediction", F.col("label"))).first().accuracy == 1.0


def test_command_line(spark, wide_path, tmp_path, capsys):
    from fieldtally.__main__ import main

    main(["count", str(wide_path / "packed.csv.bz2")])
    assert "1001" in capsys.readouterr().out
    main(["profile", str(wide_path / "plain.csv")])
    assert "zeros" in capsys.readouterr().out
    main(["sample", str(wide_path / "plain.csv"), str(tmp_path / "sample")])
    assert spark.read.text(str(tmp_path / "sample")).count() > 0


def test_shared_folder_is_the_clusters(spark, tmp_path, monkeypatch):
    from fieldtally import session

    class Conf:
        def get(self, key, default=None):
            return str(tmp_path) if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert session.shared_folder(Session()) == str(tmp_path)


def test_short_lines_and_other_specs_keep_the_width(spark, wide_path, tmp_path):
    lines = (wide_path / "plain.csv").read_text().splitlines()
    cut = [",".join(v.split(",")[:n]) for v, n in zip(lines[1:7], (1657, 1000, 300, 30, 27, 1102), strict=True)]
    (tmp_path / "short.csv").write_text("\n".join([lines[0], *cut]) + "\n")
    for spec in (RecordSpec(), RecordSpec(drop_prefixes=()), RecordSpec(fold_year=True)):
        raw, plan = jobs.open_wide(spark, str(tmp_path / "short.csv"), spec)
        rows = plan.to_arrays(raw).collect()
        assert len(rows) == 6 and {len(r["values"]) for r in rows} == {plan.width}
        full, _ = jobs.open_wide(spark, str(wide_path / "plain.csv"), spec)
        first = plan.to_arrays(full).filter(F.col("SAMPLING_EVENT_ID") == cut[0].split(",")[0]).first()
        assert [r for r in rows if r.SAMPLING_EVENT_ID == first.SAMPLING_EVENT_ID][0]["values"] == first["values"]


def test_files_without_a_header(spark, wide_path, tmp_path):
    """What the sample and split jobs write can be trained on, scored and validated."""
    source = str(wide_path / "plain.csv")
    paths = [str(tmp_path / n) for n in ("validation", "model", "predictions")]
    jobs.combined_job(spark, source, *paths)
    header = ",".join(wide_header())
    jobs.train_job(spark, paths[0], str(tmp_path / "small"), kind="random_forest", overrides={"numTrees": 2, "maxDepth": 3}, hold_out=False, header=header)
    rows = spark.read.text(paths[0]).count()
    for model in (paths[1], str(tmp_path / "small")):
        out = f"{model}-out"
        jobs.validation_job(spark, paths[0], model, out)
        assert jobs.accuracy_job(spark, out).first().total == rows
        jobs.score_job(spark, paths[0], model, f"{model}-scores", single_file=True)
        assert spark.read.text(f"{model}-scores").count() == rows + 1
    jobs.validation_job(spark, source, paths[1], str(tmp_path / "held"), part="validation")
    assert jobs.accuracy_job(spark, str(tmp_path / "held")).first().total == rows


def test_jobs_read_files_without_a_header(spark, wide_path, tmp_path):
    """Profile, sample, correlate and combined of a file whose names are given apart equal those of the file with a header."""
    lines = (wide_path / "plain.csv").read_text().splitlines()
    (tmp_path / "bare.csv").write_text("\n".join(lines[1:]) + "\n")
    bare, source, header = str(tmp_path / "bare.csv"), str(wide_path / "plain.csv"), lines[0]
    assert jobs.profile_job(spark, bare, header).collect() == jobs.profile_job(spark, source).collect()
    for path, where, names in ((bare, "a", header), (source, "b", None)):
        jobs.sample_job(spark, path, str(tmp_path / f"sample-{where}"), names)
    samples = [sorted(r.value for r in spark.read.text(str(tmp_path / f"sample-{w}")).collect()) for w in "ab"]
    assert samples[0] == samples[1] and samples[0]
    report = jobs.combined_job(spark, bare, *(str(tmp_path / n) for n in ("validation", "model", "predictions")), header=header).first()
    assert report.total > 100 and 0.5 < report.auc <= 1 and 0 <= report.auc_deviation < 0.2
    assert spark.read.text(str(tmp_path / "validation")).count() == report.total


def test_correlation_of_all_columns(spark, wide_path, tmp_path):
    lines = (wide_path / "plain.csv").read_text().splitlines()
    (tmp_path / "bare.csv").write_text("\n".join(lines[1:]) + "\n")
    jobs.correlation_job(spark, str(tmp_path / "bare.csv"), str(tmp_path / "matrix"), header=lines[0], all_columns=True)
    _, plan = jobs.open_wide(spark, str(wide_path / "plain.csv"), RecordSpec(drop_names=(), drop_prefixes=()))
    matrix = spark.read.parquet(str(tmp_path / "matrix"))
    assert plan.width > 1657 and matrix.count() == (plan.width + 1) ** 2


def test_index_follows_the_input(spark, wide_path, tmp_path):
    """Several bzip2 and plain files, each cut into splits: the index is the line's number in the files' order."""
    import bz2

    from fieldtally.operators.order import input_index
    from fieldtally.sources.text import read_lines

    lines = (wide_path / "plain.csv").read_text().splitlines()
    header, rows = lines[0], [f"{i},{v[:3000]}" for i, v in enumerate(lines[1:])]
    parts = [rows[:400], rows[400:401], [], rows[401:700], rows[700:]]
    for k, part in enumerate(parts):
        text = "\n".join([header, *part]) + "\n"
        (tmp_path / f"part-{k}.txt.bz2").write_bytes(bz2.compress(text.encode(), 1)) if k % 2 else (tmp_path / f"part-{k}.txt").write_text(text)
    options = {"spark.sql.files.maxPartitionBytes": "40000", "spark.sql.files.openCostInBytes": "10000"}
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        source = read_lines(spark, str(tmp_path), in_order=True, without=header)
        assert source.select("_file", "_block").distinct().count() > 10
        numbered = input_index(source)
        found = [r.value for r in numbered.orderBy("index").collect()]
        assert found == rows and [r["index"] for r in numbered.orderBy("index").collect()] == list(range(len(rows)))
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
