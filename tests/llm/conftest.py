import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from delaycast.llm.kit import ship
    from delaycast.session import build_session

    s = build_session("local[4]", shuffle_partitions=4)
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    ship(s)
    return s


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, row string, rank int, score double"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names the operators use themselves."""
    def make(rows):
        full = []
        for r in rows:
            doc, text, lang, source = (*r, "en", "src0")[:4] if len(r) < 4 else r
            full.append((doc, text, lang, source, None if text is None else len(text), "k", "r", 1, 0.5))
        return spark.createDataFrame(full, SCHEMA)

    return make
