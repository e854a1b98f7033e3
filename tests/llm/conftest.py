"""Tables with everything that real ones may hold: nulls, empty and very long texts, ties, copies."""

import pytest

DOC_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, host string, _found int"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def documents():
    texts = [
        None, "", "   \n\t ", "one", "Two words", LONG, LONG, "é漢字 😀 ▁ <s> <|endoftext|> don't 1.2.3.4", "a" * 5000,
        "<|endoftext|>" * 30, "1234567890 " * 40, "!!! ??? ...", f"Before it. {ITEM.upper()} after.", f"{ITEM}, {ITEM}",
        "mail me at a.b@c.example.org or +1 (555) 123-4567, card 4111 1111 1111 1111, host 10.0.0.1.",
        "tail space ", " lead", "x\ny\nx\nx", "\x00nul\x1cfile\x85next", "same text here", "same text here",
    ]
    rows = [(i, t, "en" if i % 2 else None, "s", len(t or ""), "clash", "clash", 1) for i, t in enumerate(texts)]
    return rows + [rows[4], (None, "no id at all", "en", None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(documents(), DOC_COLUMNS).write.parquet(f"{path}/documents.parquet")
    pages = [
        (0, None, None), (1, "", ""), (2, "http://A.Example.com/en/3?x#y", "<p>é</p>"), (3, "http://b.net", "same"),
        (4, "https://www.example.com/en/", "same"), (5, "no scheme", "same"), (6, "x://u@h.example.com:80/es/1", LONG),
        (7, "http://q.net/fr/4\r\nInjected: yes", "  "), (7, "http://q.net/fr/4", "  "), (None, "http://n.org/", "same"),
        (9, "http://1.2.3.4/a", "\r\n\r\nWARC/1.1\r\n"), (10, "http://x.co.uk/en/1", None), (11, "://", ""),
    ]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    items = [("i2", ITEM), ("i10", ITEM), ("short", "Two words"), ("none", None), ("blank", " . "), (None, "tail space")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(1, 0, 0), (3, 1, 0), (3, 0, 1), (4, None, None), (None, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [0.5, -0.25, 1.0]), (1, [0.5, -0.25, 1.0]), (2, None), (3, [1.0, None, 2.0]), (4, [nan, 0.0, 1.0]), (5, [inf, 0.0, 1.0]),
        (6, [0.0, 0.125, -1.0]), (7, []), (8, [2.0, 3.0]), (9, [-1.5, 0.75, 0.0]), (9, [-1.5, 0.75, 0.0]), (None, [0.25, 0.5, 0.75]),
        (11, [3e38, 0.0, 0.0]), (12, [-0.0, 1e-9, 5.0]),
    ]
    spark.createDataFrame([(*v, 1, 7) for v in vectors], "vec_id long, embedding array<float>, label int, n int").write.parquet(
        f"{path}/embeddings.parquet"
    )
    turns = [
        (0, 0, "user", "hello there"), (0, 1, "bot", "hi"), (0, 2, "user", None), (0, 2, None, "tie"), (1, None, "user", "first"),
        (1, 0, "user", "second"), (2, 0, "user", "hello there"), (2, 1, "bot", "hi"), (3, 5, "user", "hello there"), (19, 0, None, None),
        (20, 0, "user", LONG), (21, 0, "user", "x"), (21, 0, "user", "x"), (25, 0, "a", "b"), (26, 1, "a", "b"), (-1, 0, "user", "minus"),
        (None, 0, "user", "nobody"), (45, 0, "user", "no base"), (47, 0, "user", "no base"), (66, 0, "user", " \t "),
    ]
    spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, depth string").write.parquet(
        f"{path}/conversations.parquet"
    )
    return path


@pytest.fixture(scope="session")
def empty_dir(spark, odd_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "pages", "benchmark", "labels", "embeddings", "conversations"):
        spark.read.parquet(f"{odd_dir}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(params=["odd", "sf0.001"])
def any_dir(request, odd_dir, sf_dir):
    return odd_dir if request.param == "odd" else sf_dir


@pytest.fixture
def texts(spark):
    """(doc_id, text) of all documents of a folder."""

    def read(path):
        rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
        return [(r.doc_id, r.text) for r in rows]

    return read
