import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, component_id int, score int"


@pytest.fixture()
def docs(spark):
    """Documents of given texts; extra columns have names that the operators use themselves."""
    def make(rows):
        full = [(i, t, lang, "s", 0, "x", 7, 8) for i, t, lang in
                [(r[0], r[1], r[2] if len(r) > 2 else "en") for r in rows]]
        return spark.createDataFrame(full, DOC)
    return make


