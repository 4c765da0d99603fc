"""Every query over tables with one very long text, nulls, and further columns; and over empty tables."""

import random

import pytest

from ledgerline.llm.queries import QUERIES

LONG = 5_000_000
KEYED = {"op2_url_filter": "pages", "op9_chat_format": "conversations", "op11_hard_negatives": "embeddings", "op13_prefix_trie": "conversations"}
#: Rows that a query adds to those of its table, or that make one node or pair each.
OWN_ROWS = {"op9_chat_format", "op10_packing", "op11_hard_negatives", "op13_prefix_trie"}


def long_text():
    rng = random.Random(1)
    known = ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    return " ".join(rng.choice(known) + rng.choice(["", "", "", ".\n"]) for _ in range(LONG // 6))[:LONG]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root, text = str(tmp_path_factory.mktemp("long")), long_text()
    long = "1" + text[1:]
    rows = {
        "documents": [(1, text, "en", "a", LONG), (2, None, None, None, None), (3, "short one", "fr", "b", 9), (4, text[: LONG // 2], "en", "a", 1)],
        "benchmark": [(1, text[100:400]), (2, None), (3, text[:300_000])],
        "pages": [(1, f"http://example.org/{text[:200_000]}", text), (2, None, None), (3, "https://x.com/de/", "*$*")],
        "conversations": [(1, 0, "user", long), (1, 1, "assistant", long), (2, 0, None, None), (20, None, "user", "hi")],
        "embeddings": [(100, [0.5] * 3000, 1), (101, [0.25] * 3000, 1), (102, [0.25] * 2999, 2), (103, None, 2), (104, [0.1], None)],
    }
    schemas = {
        "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
        "benchmark": "item_id bigint, text string",
        "pages": "page_id bigint, url string, html string",
        "conversations": "conv_id bigint, turn bigint, role string, text string",
        "embeddings": "vec_id bigint, embedding array<float>, label int",
    }
    for kind in ("long", "empty"):
        for name, data in rows.items():
            made = spark.createDataFrame(data if kind == "long" else [], f"{schemas[name]}, kept string" if kind == "empty" else schemas[name])
            made.write.parquet(f"{root}/{kind}/{name}.parquet")
    return root, {name: len(data) for name, data in rows.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_a_very_long_text(spark, tables, name):
    root, sizes = tables
    rows = QUERIES[name](spark, f"{root}/long").collect()
    if name in OWN_ROWS:
        assert rows
    else:
        assert len(rows) == sizes[KEYED.get(name, "documents")]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tables, name):
    root, _ = tables
    rows = QUERIES[name](spark, f"{root}/empty").collect()
    assert len(rows) == (1 if name == "op9_chat_format" else 0)
