import pytest
from pyspark.sql import types as T


@pytest.fixture
def documents(spark):
    """A table of documents with awkward columns beside them."""

    def make(rows, extra="_norm string, shard string, Kept string"):
        schema = T.StructType([*T.StructType.fromDDL("doc_id long, text string, lang string, source string, n_chars long").fields, *T.StructType.fromDDL(extra).fields])
        more = len(schema) - 2
        return spark.createDataFrame([(*r, *[None] * more) for r in rows], schema)

    return make
