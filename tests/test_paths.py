"""Inputs and warehouses are found by whatever path Spark can read, as they are now."""
import os

import pytest

from wardline.plans.pipeline import run_pipeline
from wardline.plans.queries import QUERY_AS_OF, catalog
from wardline.plans.registry import Catalog
from wardline.session import ensure_checkpoint_dir
from wardline.sources import fs, synth


def test_warehouse_by_uri_is_read_back(spark, small_root, tmp_path):
    wh = f"file://{tmp_path}/wh"
    run_pipeline(spark, f"file://{small_root}", wh, as_of=QUERY_AS_OF, register=False)
    cat = Catalog(spark, f"file://{small_root}", warehouse=wh, as_of=QUERY_AS_OF)
    assert cat.is_written("silver.encounter_silver") and not cat.is_written("silver.nothing")
    files = cat.build("gold.fact_encounter").inputFiles()
    assert files and all("/silver/" in f for f in files)
    assert fs.exists(spark, fs.join(wh, "_audit.json")) and not os.path.exists("file:")


def test_changed_input_is_seen_in_the_same_session(spark, tmp_path):
    root = synth.write_inputs(spark, str(tmp_path / "a"), n_patients=50, n_providers=10, n_departments=5, n_diagnoses=9,
                              n_encounters=400)
    before = catalog(spark, root).table("bronze.raw_encounters").select("provider_bk").distinct().count()
    more = synth.write_inputs(spark, str(tmp_path / "b"), n_patients=50, n_providers=50, n_departments=5, n_diagnoses=9,
                              n_encounters=400)
    spark.read.parquet(f"{more}/supplier.parquet").write.mode("overwrite").parquet(f"{root}/supplier.parquet")
    after = catalog(spark, root).table("bronze.raw_encounters").select("provider_bk").distinct().count()
    assert before <= 10 < after


def test_checkpoint_folder_must_be_named_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())
