import pytest


@pytest.fixture(scope="session")
def vocabulary():
    P = pytest.importorskip("public_tokenizers")
    return P.path("word_bpe_49k.json")
