import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)`` rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def with_clashes():
    """Extra columns under the names that operators use inside or return."""

    def add(df):
        names = ("shard slot size rank taken copies score predicted component_id fp root n key bin before text_crc32 "
                 "law link name target diff kept row n_links verdict host path rule item shingle w h words").split()
        for n in names:
            if n not in df.columns:
                df = df.withColumn(n, F.lit("clash"))
        return df

    return add


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], T._parse_datatype_string(DOCS))
