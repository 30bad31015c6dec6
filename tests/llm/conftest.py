import pytest


@pytest.fixture()
def tables(spark, tmp_path):
    """Writes small tables as a folder that queries read."""

    def write(**frames):
        for name, (rows, schema) in frames.items():
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write
