from wardline.plans.pipeline import run_pipeline
from wardline.plans.queries import QUERY_AS_OF
from wardline.sources import synth


def test_generator_is_deterministic_and_sized(spark):
    a = synth.generate_inputs(spark, n_patients=300, n_encounters=2000, partitions=3)
    b = synth.generate_inputs(spark, n_patients=300, n_encounters=2000, partitions=7)
    assert a["customer"].count() == 300 and a["orders"].count() == 2000
    n_lines = a["lineitem"].count()
    assert 2000 <= n_lines <= 8000
    for t in ("customer", "orders", "lineitem"):
        assert a[t].exceptAll(b[t]).count() == 0  # same rows for any partitioning
    # whole line rows are unique (the lab key relies on it)
    assert a["lineitem"].distinct().count() == n_lines
    c = synth.generate_inputs(spark, n_patients=300, n_encounters=2000, seed=7)
    assert c["customer"].exceptAll(a["customer"]).count() > 0


def test_pipeline_runs_on_generated_inputs(spark, tmp_path):
    root = synth.write_inputs(spark, str(tmp_path / "in"), n_patients=300, n_providers=20,
                              n_departments=15, n_diagnoses=40, n_encounters=2000)
    audit = {a["table"]: a for a in run_pipeline(spark, root, str(tmp_path / "wh"), as_of=QUERY_AS_OF,
                                                 register=False)}
    assert audit["bronze.raw_encounters"]["rows"] == 2000
    assert audit["bronze.raw_departments"]["rows"] == 15
    assert audit["gold.fact_encounter"]["input_rows"] == 2000
    assert audit["graphql.current_ward_census"]["input_rows"] > 0
