import re

import public_tokenizers
import pytest

from tidemark.llm import token_counts
from tidemark.llm.token_counts import MARK, Trie, zipf_scores


@pytest.fixture(scope="module")
def scores():
    return zipf_scores(public_tokenizers.path("piece_bpe_32k.model"))


def brute(word, scores):
    """Best (score, tokens) of a word, position by position, without a trie."""
    byte = min(scores.values()) - 1.0
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = []
        for start in range(end):
            piece = scores.get(word[start:end])
            if piece is not None:
                options.append((best[start][0] + piece, best[start][1] + 1))
        if word[end - 1] not in scores:
            size = len(word[end - 1].encode())
            options.append((best[end - 1][0] + byte * size, best[end - 1][1] + size))
        best.append(max(options, key=lambda o: (o[0], -o[1])))
    return best[-1][1]


def count(text, scores):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return len(found), sum(brute(MARK + w[:400], scores) for w in found)


def test_corpus(corpus, scores):
    rows = {r["doc_id"]: r["text"] for r in corpus.filter("doc_id < 60").collect()}
    found = token_counts.token_counts(corpus.filter("doc_id < 60"), scores).collect()
    assert {r["doc_id"]: (r["n_pretokens"], r["n_tokens"]) for r in found} == {
        i: count(t, scores) for i, t in rows.items()
    }


def test_odd_rows(odd, none, scores):
    found = token_counts.token_counts(odd, scores)
    assert found.count() == odd.count()
    by_id = {r["doc_id"]: r for r in found.collect()}
    for i in (6, 7, 8):
        assert (by_id[i]["n_pretokens"], by_id[i]["n_tokens"]) == (0, 0)
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    for i in (12, 13):
        assert by_id[i]["n_tokens"] == count(texts[i], scores)[1]
    assert token_counts.token_counts(none, scores).count() == 0


def test_limits_change_nothing(scores, monkeypatch):
    texts = ["internationalisation", "international", "zzzqqq東京x" * 30, "a"]
    free = [Trie(scores).count(MARK + t) for t in texts]
    monkeypatch.setattr(token_counts, "DEPTH", 4)
    monkeypatch.setattr(token_counts, "MOST_NODES", 6)
    tight = Trie(scores)
    assert [tight.count(MARK + t) for t in texts * 2] == free * 2
    assert free == [brute(MARK + t, scores) for t in texts]


def test_prefixes_are_scored_once(scores):
    trie = Trie(scores)
    trie.count("abcdef")
    nodes = trie.nodes
    trie.count("abcd")
    trie.count("abcdefg")
    assert trie.nodes == nodes + 1
