import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import LONG, docs, empty

from tripgauge.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabularies():
    return {n: pieces.Vocabulary(MODEL, n) for n in (1, 2, 4, 7)}


def every_path(v, text):
    """All segmentations of a short text, best first, by plain recursion."""
    s, out = " " + text, []

    def go(i, score, ids):
        if i == len(s):
            out.append((score, np.array(ids, dtype="<u4").tobytes()))
            return
        for j in range(i + 1, len(s) + 1):
            if s[i:j] in v.score:
                go(j, score + v.score[s[i:j]], [*ids, v.id_of[s[i:j]]])
        if s[i] not in v.score:
            data = s[i].encode()
            go(i + 1, score + v.byte_score * len(data), ids + [v.byte_ids[b] for b in data])

    go(0, 0, [])
    return sorted(out, reverse=True)


@pytest.mark.parametrize("text", ["the cat", "a  b", "is\nof", "▁x", "Éa 😀", "aa aa", "a", " ", "a a a a", "x.y,", "(it's)", "a1b2", "..."])
def test_best_paths(vocabularies, text):
    for n, v in vocabularies.items():
        all_paths, got = every_path(v, text), v.encode(text)
        assert [s for s, _ in got] == [s for s, _ in all_paths[:n]]
        assert len({ids for _, ids in got}) == len(got) and set(got) <= set(all_paths)
        assert all(v.decode(ids) == text for _, ids in got)


def test_pieces_decode_as_the_library_does(vocabularies):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in ["Hello there, world.", "naïve café über", "tabs\tand\nlines", LONG[:500]]:
        _, ids = vocabularies[1].encode(text)[0]
        assert model.decode(np.frombuffer(ids, "<u4").tolist()) == text


def test_keeping_answers_changes_nothing(vocabularies):
    small, text = pieces.Vocabulary(MODEL, 4, room=3), "some words here and some words there, all of them short."
    assert small.encode(text) == vocabularies[4].encode(text)


def test_awkward_rows(spark):
    table = docs(spark)
    rows = pieces.encode(table, MODEL).collect()
    assert len(rows) == table.count() and all(r.round_trip for r in rows)
    for r in rows:
        assert r.n_tokens == len(r.ids) and r.score == r.scores[0] == max(r.scores) and len(r.scores) == len(r.crc32s) == r.n_paths
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {0}
    assert pieces.encode(empty(spark), MODEL, with_ids=False).count() == 0
