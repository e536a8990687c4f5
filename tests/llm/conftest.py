import pytest

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, part int, fp long, ord long, "
              "line string, component_id long, score double, copy long, item string, at long, row long")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows and
    columns whose names the operators use themselves."""
    base = " ".join(f"word{i % 37}x{i % 11}" for i in range(120))
    shared = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    long = " ".join(f"tok{i}" for i in range(6000))
    texts = [(1, base), (2, base), (2, base), (3, base + " tail"), (4, ""), (5, None), (None, base), (None, None),
             (6, shared + "\n" + shared + "\nshort\n" + base), (7, shared.replace("theta", "thetb") + "\nunlike the rest of them all, surely so"),
             (8, "  \t\n \n"), (9, long), (10, "one"), (11, "One"), (12, "é" * 70 + " ß" + "é" * 70), (13, "x" + "é" * 70)]
    rows = [(i, t, None, "src1" if k % 2 else None, len(t) if t else None, 1, 2, 3, "l", 4, 0.5, 5, "it", 6, 7)
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
