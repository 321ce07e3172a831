import collections
import random
import re

from rosterlake.llm.quality_rules import Divergence, judge, keep

from odd_rows import documents, empty, ODD_TEXTS  # noqa: F401  (fixtures)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def prose(i):
    rng = random.Random(i)
    return " ".join(rng.choice(["the", "of", "and", "in", f"word{rng.randrange(97)}", f"term{rng.randrange(89)}"]) + rng.choice(["", "", "", "."])
                    for _ in range(150))


def test_counts_and_verdicts(documents):
    texts = ODD_TEXTS + [prose(i) for i in range(40)] + [
        "a b c a b c a b c " * 30, "line one\nline one\n\nline two\n line one\r\nline one\r\n#*$%&|<>" * 4,
        " ".join(w.upper() + "!!" for w in prose(3).split()), " ".join(w + "###" for w in prose(4).split())]
    # One long repetitive text would be most of a reference: the odd ones have languages of their own.
    docs = documents([(i, t, (None, "xx")[i % 2] if i < len(ODD_TEXTS) else "en") for i, t in enumerate(texts)], extra=("n_words", "text2", "row", "kept"))
    settings = Divergence(reference_words=100)
    got = {r.doc_id: r for r in judge(docs, settings=settings).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert tuple(got[i][c] for c in COUNTS) == counts(text), (i, text and text[:60])
        assert not (got[i].base_failed and got[i].kept)
    assert all(got[len(ODD_TEXTS) + i].kept for i in range(40))
    assert not got[len(texts) - 1].kept and not got[len(texts) - 2].kept
    assert keep(docs, settings=settings).columns == docs.columns


def test_no_rows_and_no_reference(documents, empty):
    assert judge(empty).count() == 0
    assert [(r.base_failed, r.kept) for r in judge(documents([(None, None), (1, "short text")])).collect()] == [(True, False)] * 2
