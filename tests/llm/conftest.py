import pytest

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text) pairs; None makes nulls."""
    def make(rows):
        return spark.createDataFrame([(i, t, None, "s", None) for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long")
    return make


@pytest.fixture
def data_dir(spark, tmp_path):
    """A folder of given tables, as the queries read it."""
    def make(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return make


ODD_TEXTS = [None, "", " ", "\n\n a", "it's  'll x''s 'sabc I'm", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>\n",
             "aaaaaaaaaa aaaa aaa", " \t x y 　z ", "é1²³ ½ ٣ 日本語 😀😀", "\x01 a  b\x1c", "x " * 400 + "   ", "'", "x" * 3000,
             "hello world", "hello world"]
