import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from mdquarry.session import checkpoint_dir, local_session

    s = local_session("*", app="mdquarry-tests")
    checkpoint_dir(s)  # tests only: a temp folder when the session names none
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_corpus(spark):
    from mdquarry.plans.queries import DerivedCorpus
    from mdquarry.sources.fixtures import load_md_documents

    return DerivedCorpus(load_md_documents(spark, SF_SMALL))
