import pytest

from tablehaul.llm.common import ready


@pytest.fixture(autouse=True)
def settings(spark):
    ready(spark)


@pytest.fixture
def docs(spark):
    """Documents of (doc_id, text) with columns that clash with the operators' own names."""

    def make(rows, **extra):
        names = {"text_digest": "x", "row_number": "y", "simhash": "z", "leak": "w", **extra}
        full = [(i, t, "en", "s", len(t or ""), *names.values()) for i, t in rows]
        fields = ", ".join(f"{n} string" for n in names)
        return spark.createDataFrame(
            full, f"doc_id long, text string, lang string, source string, n_chars long, {fields}"
        )

    return make
