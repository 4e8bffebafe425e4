import random

import pytest


@pytest.fixture(scope="session")
def words():
    """Invented words: word(rng) gives one."""
    parts = "an ba co de el fi go hu in jo ka le mi no or pa qu re si to un ve wa xi yo za".split()

    def word(rng: random.Random) -> str:
        return "".join(rng.choices(parts, k=rng.randint(2, 4)))

    return word


@pytest.fixture()
def saved(spark, tmp_path):
    """Write rows as a Parquet table and read it; operators number the rows of files."""
    count = iter(range(1000))

    def save(rows, schema, name=None, parts=3):
        path = f"{tmp_path}/{name or f't{next(count)}'}.parquet"
        spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)

    return save
