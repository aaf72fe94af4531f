"""Pre-tokens of op3 are those of the tokenizer's pattern, whichever of the two classes cuts the text."""

import public_tokenizers
import regex

from featureflow.llm import unigram_counts
from featureflow.llm.byte_bpe import PLANE

TEXTS = ["", "  ", "it's  a\n\ttest 12 ", "naïve ŁÓDŹ 東京 ١٢٣ x　y", "a 😀😀 b", "\U0001d4d0\U0001d7d8 z", "￿퟿ 1", "...!? 'll"]


def test_pre_tokens_are_those_of_the_pattern():
    find = unigram_counts.pre_tokens(public_tokenizers.PATTERN)
    assert [find(t) for t in TEXTS] == [regex.findall(public_tokenizers.PATTERN, t) for t in TEXTS]


def test_plain_texts_are_cut_by_classes_of_one_plane(monkeypatch):
    """op3's CPU seconds: only a text with code points beyond the first plane is cut by the classes that hold them."""
    used = []
    original = unigram_counts.compile_pattern

    class Noted:
        def __init__(self, end, pattern):
            self.end, self.pattern = end, pattern

        def findall(self, text):
            used.append(self.end)
            return self.pattern.findall(text)

    monkeypatch.setattr(unigram_counts, "compile_pattern", lambda p, end=0x110000: Noted(end, original(p, end)))
    find = unigram_counts.pre_tokens(public_tokenizers.PATTERN)
    find("plain é 東"), find("a 😀")
    assert used == [PLANE, 0x110000]
