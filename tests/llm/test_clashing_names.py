"""Further columns of the input, named as an operator's helpers, neither clash nor get lost."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import pagemill.llm
from pagemill.llm import bpe, jaccard, langid, lines, mixing
from pagemill.llm.names import unused
from pagemill.llm.queries import vocabulary

OWN = {"doc_id", "text", "lang", "source", "n_lines", "n_dropped", "lang_pred", "score", "ids"}


def helpers(module):
    """Every name that the module quotes with an underscore, or gives to a column."""
    text = (Path(pagemill.llm.__file__).parent / f"{module}.py").read_text()
    quoted = re.findall(r"\"(_[a-z_]+|[a-z_]+_)\"", text) + re.findall(r"alias\(\"([a-z_0-9]+)\"\)", text)
    return sorted(set(quoted) - OWN)


CASES = {
    "bpe": lambda docs: bpe.encode(docs, vocabulary(), parts=("ids",)),
    "langid": lambda docs: langid.predict(docs, langid.fit(docs)),
    "jaccard": jaccard.one_of_each,
    "lines": lines.drop_spread_lines,
    "mixing": mixing.take,
}


@pytest.mark.parametrize("module", CASES)
def test_helper_names_are_free_for_callers(spark, module):
    texts = ["one two three four five six", "one two three four five six", "a line of all\nown words of this one", "a line of all\nquite another text here", "a line of all\nand a third one of them", None]
    rows = [(i, t, "en", f"s{i}") for i, t in enumerate(texts)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = helpers(module)
    wide = plain.withColumns({n: F.concat(F.lit(f"{n} of "), "doc_id") for n in names})
    got = CASES[module](wide)
    assert set(wide.columns) <= set(got.columns)
    found = got.collect()
    for r in found:
        assert all(r[n] == f"{n} of {r.doc_id}" for n in names)
    wanted = CASES[module](plain)
    key = lambda rows: sorted(str([r[c] for c in wanted.columns]) for r in rows)
    assert key(found) == key(wanted.collect())


def test_unused_names(spark):
    df = spark.range(1).select(F.col("id").alias("_ID"), F.col("id").alias("__id"))
    assert unused(df, "_id", "_k", "_k") == ["___id", "_k", "__k"]
