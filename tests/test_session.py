"""Intermediate tables: written to the shared folder, read back, dropped."""

import glob

from corpusmill import session


def test_materialise_and_drop(spark):
    folder = session.shared_dir(spark).removeprefix("file://")
    kept, dropped = (session.materialise(spark.range(10), name) for name in ("kept", "dropped"))
    assert kept.count() == dropped.count() == 10 and len(glob.glob(f"{folder}/corpusmill-dropped-*")) == 1
    session.drop_materialised(dropped)
    session.free_shuffles(spark)
    assert not glob.glob(f"{folder}/corpusmill-dropped-*") and kept.count() == 10
    session.clean(spark)
    assert not glob.glob(f"{folder}/corpusmill-*")
    session.drop_materialised(spark.range(1))
    spark.range(3).write.parquet(f"{folder}/mine")
    session.drop_materialised(spark.read.parquet(f"{folder}/mine"))
    assert spark.read.parquet(f"{folder}/mine").count() == 3


def test_stores_of_queries_go(spark, sf_dir):
    from corpusmill.plans import catalogue

    folder = session.shared_dir(spark).removeprefix("file://")
    assert catalogue.QUERIES["ingest_store"](spark, sf_dir).count() > 0 and glob.glob(f"{folder}/corpusmill-store-*")
    session.clean(spark)
    assert not glob.glob(f"{folder}/corpusmill-store-*")


def test_stages_begin_on_collected_heaps(spark):
    import corpus_pipeline

    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[-1:]:
        before = full()
        assert stage(spark, docs, "").count() > 0 and full() > before, name
