import sys
import time
import unicodedata


def test_scores_count_each_sign_once():
    """The time doesn't grow with the number of different odd signs in a text."""
    from inkwell.sources.encodings import body_score, sample_score, whole_score

    odd = "".join(map(chr, range(0xF0000, 0xFFFFE))) * 10
    for score in (sample_score, body_score, whole_score):
        score("a")
        start = time.process_time()
        score(odd)
        assert time.process_time() - start < 1.5


def test_every_sign_is_of_its_kind():
    from inkwell.sources.encodings import _counts

    for first in range(0, sys.maxunicode + 1, 4096):
        text = "".join(sign for sign in map(chr, range(first, first + 4096)) if unicodedata.category(sign) != "Cs")
        plain = [sign for sign in text if sign not in "\r\n\t"]
        want = [
            sum(sign.isprintable() or sign in "\r\n\t" for sign in text), sum("㐀" <= sign <= "鿿" or "豈" <= sign <= "﫿" for sign in text), sum("一" <= sign <= "鿿" for sign in text), text.count("�"), text.count("\0"),
            sum(unicodedata.category(sign) == "Cc" for sign in plain), sum(unicodedata.category(sign)[0] == "C" for sign in plain), sum("\x80" <= sign <= "\xff" for sign in text),
        ]
        assert _counts(text) == want
