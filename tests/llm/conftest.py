import pytest
from llm_helpers import words


@pytest.fixture(scope="session")
def awkward():
    """Ids and texts: null, empty, blank, short, long, repeated, and rows given twice."""
    long_text = " ".join(words(30_000, 1))
    return [
        (0, None), (1, ""), (2, " \n\t "), (3, "One"), (4, "one two three"), (5, "a\n\nb　c  d \x1c e  <|endoftext|>  x"), (6, long_text),
        (7, long_text), (8, "é́ ß ΑΣ 123 !!"), (9, "x" * 5000), (10, "same text here"), (10, "same text here"), (None, "no id at all"), (None, None),
    ]
