import pytest

# Names that operators use inside; extra columns of the input may bear them.
CLASHING = "digest keep_id group_size kept salt key keys line_id score predicted ids starts row body rank".split()


@pytest.fixture
def documents(spark):
    """A frame of (doc_id, text) pairs with extra columns under names the operators use."""

    def make(pairs, id_col="doc_id", text_col="text"):
        schema = f"{id_col} bigint, {text_col} string, " + ", ".join(f"{name} string" for name in CLASHING)
        return spark.createDataFrame([(a, b, *["x"] * len(CLASHING)) for a, b in pairs], schema)

    return make
