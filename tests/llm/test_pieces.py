"""Pieces of texts, block by block, and the work of replaying merges."""

import random

import numpy as np

from tidegrid.llm import bpe
from tidegrid.llm.pieces import Pieces


def test_pieces_of_a_block_equal_those_of_its_texts():
    rng = random.Random(5)
    signs = ["a", "b", " ", " ", "\n", "\t", "é", "　", "x,", "'s", "1"]
    for _ in range(200):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice(signs) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 6))]
        block, single = Pieces(), Pieces()
        found, n = block.of_block(texts)
        want = [[single.texts[k] for k in single.numbers(t or "")] for t in texts]
        assert [block.texts[k] for k in found] == [p for row in want for p in row] and n.tolist() == list(map(len, want))


def test_a_word_of_a_block_is_looked_up_once():
    pieces, asked = Pieces(), []

    class Counted(type(pieces.following)):
        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

    pieces.following = Counted(pieces.texts, " ")
    _, n = pieces.of_block(["a b c b", "b c b c", "c c"])
    assert n.tolist() == [4, 4, 2] and sorted(asked) == ["b", "c"]


def test_a_pair_is_looked_up_when_it_arises_alone():
    """A place is not looked up again when its rank comes; in these pieces a merge makes one new pair at most on average."""
    ranks = {bytes([k]): k for k in range(256)}
    for word in (b"ab", b"abc", b"cd", b"bcd", b"abcd", b"aa", b"aaaa"):
        ranks[word] = len(ranks)
    merges, looked = bpe.Merges(ranks), []
    plain = merges.look_up
    merges.look_up = lambda left, right: looked.append(len(left)) or plain(left, right)
    pieces = [b"abcd", b"aaaaa", b"cdab", b"bcdx", b"q"] * 20
    flat, n = bpe.replay_block(pieces, merges)
    length = sum(map(len, pieces))
    assert [b"".join(merges.tokens[t] for t in part) for part in np.split(flat, np.cumsum(n)[:-1])] == pieces
    assert flat[: n[0]].tolist() == [ranks[b"abcd"]] and flat[n[0] : n[0] + n[1]].tolist() == [ranks[b"aaaa"], ord("a")]
    assert sum(looked) <= length + (length - len(flat))
