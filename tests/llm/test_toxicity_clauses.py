"""What the matches of a clause emit, by the words around them."""

import pyarrow as pa
import pytest

from laketier.llm import toxicity


def emitted(text):
    grammar = toxicity.Grammar({"idiot": 4.0})
    row = grammar.features(pa.array([text], pa.string()))[0]
    return toxicity.FEATURES[row[:5].argmax()] if row.any() else None


@pytest.mark.parametrize("text, want", [
    ("I will kill you", "threat"), ("we will destroy them", "threat"),
    ("burn their house", "threat"), ("You will kill time.", "threat"),
    ("I will kill one two three you", "threat"), ("I will kill one two three four you", None),
    ("I will kill time. You laugh.", None), ("idiot, you know nothing", "targeted"),
    ("An idiot passed by.", "plain"), ("An idiot. You laugh.", "plain"),
    ("stupid,idiot", "plain"), ("you/idiot", "targeted"), ("idiot\u00a0you", "targeted"),
    ("the end.Idiot. You laugh", "plain"), ("an idiot's end", "plain"), ("IDIOT!!! you", "plain"),
    ("you aren't an idiot", "negated"), ("' ... !", None), ("... idiot", "plain"),
    ("I will not kill you", "negated"), ("he said I will kill you", "reported")])
def test_targets_on_either_side_of_a_match(text, want):
    assert emitted(text) == want
