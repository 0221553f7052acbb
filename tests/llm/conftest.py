import pytest

# an edge case of everything: nulls, empty and long texts, ties, repeated rows, columns with clashing names
LONG = "".join(f"word{i} and {i * 7919 % 1000} more, " for i in range(4000))


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [
        (1, "Same Text here for all of us", "x", 1), (2, "same text HERE for all of us", None, 2), (2, "same text HERE for all of us", None, 2),
        (None, "lonely row without an id", "y", 3), (3, None, "z", 4), (4, "", "z", 4), (5, "   \n\t ", "z", 5),
        (6, "Ünïcode ÄÖ text ß ﬁ 日本語 and é", "u", 6), (7, LONG, "l", 7), (8, LONG + " tail", "l", 8), (9, "x", "s", 9),
    ]
    # column names that the operators use inside
    return spark.createDataFrame(rows, "doc_id long, text string, k1 string, n long").selectExpr(
        "doc_id", "text", "k1", "n", "n AS block", "k1 AS spans", "n AS `a.b`", "k1 AS lang")


@pytest.fixture(scope="session")
def no_docs(spark, edge_docs):
    return spark.createDataFrame([], edge_docs.schema)
