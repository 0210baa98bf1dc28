import pytest


@pytest.fixture(scope="session")
def texts():
    """Cases that every operator has to bear: null, empty, blank, ties, copies, very long words and texts."""
    return [
        None, "", " \n\t ", "one", "two words", "Ünïcödé, ça va? 日本語 テキスト", "a b c a b c a b c", "same text here", "same text here",
        "x" * 5000, "word " * 3000, "line\nline\nline\n\nother line\n", "mail me.now@host.example.com or +1 (017) 555-7713 at 10.0.0.1 today",
        "card 4111 1111 1111 1111 and 4111-1111-1111-1112", "<|endoftext|> is text", "a\u00a0b \u3000 c\u2003d  e", "it's  we'll\r\n\r\n  end  ",
    ]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Documents of these texts, with null ids and sources, repeated rows, and columns whose names the operators use."""
    rows = [(i, t, "en", f"src{i % 4}" if i % 5 else None, len(t or ""), 7, "x", 0.5) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "no id", None, None, None, 7, "x", 0.5)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, key string, score double").repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def sf(spark, docs, tmp_path_factory):
    """A folder of tables as the queries read them."""
    path = tmp_path_factory.mktemp("sf")
    docs.write.parquet(f"{path}/documents.parquet")
    return str(path)
