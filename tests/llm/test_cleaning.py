from dayscout.llm import queries
from dayscout.sources.files import Files, clean_scratch, shared_dir


def tables(spark):
    return {f.below.split("/")[0] for f in Files(spark).list(shared_dir(spark), deep=True) if f.below.endswith(".parquet")}


def test_stored_tables_go_once_the_result_is_written(spark, folder, tmp_path):
    clean_scratch()
    before = tables(spark)
    for name in ("op13_token_counts", "op12_prefix_trie", "op3_block_naming"):
        queries.QUERIES[name](spark, folder).write.parquet(str(tmp_path / name))
    assert tables(spark) > before
    clean_scratch()
    assert tables(spark) == before
    assert spark.read.parquet(str(tmp_path / "op13_token_counts")).count() > 0
