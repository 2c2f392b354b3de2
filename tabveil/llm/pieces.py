"""The vocabulary of a SentencePiece file as a unigram lattice, shared by counting and sampling.

A text is read with a blank before it and blanks as U+2581, as the file's tokenizer does. No
piece reaches over the place between another character and U+2581, nor over a line end, so the lattice of a text
falls into independent units at these places and equal units have equal lattices. A character without a
piece of its own stands as an unknown one, written in the pieces of its bytes. U+2581 in the
text itself is written in bytes too, which keeps decoding lossless.
"""

from __future__ import annotations

import re

import numpy as np

BLANK = "▁"
UNKNOWN_PENALTY = 10.0


class Vocabulary:
    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.decoded: list[bytes] = [b""] * sp.get_piece_size()
        for b, i in enumerate(self.bytes_ids):
            self.decoded[i] = bytes([b])
        self.automaton = ahocorasick.Automaton()
        self.single: set[str] = set()
        least = 0.0
        for i in range(sp.get_piece_size()):
            least = min(least, sp.get_score(i))
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i):
                continue
            piece = sp.id_to_piece(i)
            if BLANK in piece.lstrip(BLANK) or "\n" in piece:
                raise ValueError("a piece reaches over the end of a unit")
            self.automaton.add_word(piece, (len(piece), i, sp.get_score(i)))
            self.decoded[i] = piece.replace(BLANK, " ").encode()
            if len(piece) == 1:
                self.single.add(piece)
        self.automaton.make_automaton()
        self.unknown = least - UNKNOWN_PENALTY
        self._tree: Tree | None = None

    def matches(self, unit: str):
        """(end, length, id, score) by end, longer pieces first; id -1: the bytes of a character without a piece."""
        following, single = 0, self.single
        for last, (length, i, score) in self.automaton.iter(unit):
            while following < last:  # characters in which no piece ends
                if unit[following] not in single:
                    yield following + 1, 1, -1, self.unknown
                following += 1
            yield last + 1, length, i, score
            if length == 1:
                following = last + 1
        while following < len(unit):
            if unit[following] not in single:
                yield following + 1, 1, -1, self.unknown
            following += 1

    def tree(self) -> Tree:
        """The pieces as a tree in arrays, made on first use."""
        if self._tree is None:
            self._tree = Tree({piece: value[1:] for piece, value in self.automaton.items()})
        return self._tree

    def matches_within(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``matches`` of all units of a text, joined by line ends, as arrays: (end, length, id, score) with ends in the text."""
        ends, lengths, ids, scores = [], [], [], []
        tree = self.tree()
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        at = np.flatnonzero(points != ord("\n"))
        node, length = tree.first[points[at]], 1
        while True:
            # A character without a piece of its own is a match too.
            found = np.flatnonzero(tree.ids[node] >= 0) if length > 1 else slice(None)
            ends.append(at[found] + length)
            lengths.append(np.full(len(ends[-1]), length))
            ids.append(tree.ids[node[found]])
            scores.append(tree.scores[node[found]])
            more = (node > 0) & (node < len(tree.next)) & (at + length < len(points))
            at, node = at[more], node[more]
            if not len(at):
                break
            node = tree.next[node, tree.codes[points[at + length]]]
            at, node = at[node > 0], node[node > 0]
            length += 1
        # Longer pieces first.
        ends, lengths, ids, scores = (np.concatenate(x[::-1]) for x in (ends, lengths, ids, scores))
        order = np.argsort(ends, kind="stable")
        scores[ids < 0] = self.unknown
        return ends[order], lengths[order], ids[order], scores[order]


class Tree:
    """Pieces by their characters: node 0 is none, then nodes with further characters, then the others."""

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        inner = {piece[:k] for piece in pieces for k in range(1, len(piece))}
        nodes = [*sorted(inner), *sorted(set(pieces) - inner)]
        number = {text: n for n, text in enumerate(nodes, 1)}
        kind = np.min_scalar_type(len(nodes))
        later = sorted({c for piece in pieces for c in piece[1:]})
        self.first, self.codes = np.zeros(0x110000, kind), np.zeros(0x110000, np.min_scalar_type(len(later)))
        self.codes[[ord(c) for c in later]] = np.arange(1, len(later) + 1)
        self.next = np.zeros((len(inner) + 1, len(later) + 1), kind)
        self.ids, self.scores = np.full(len(nodes) + 1, -1, "i8"), np.zeros(len(nodes) + 1)
        for text, n in number.items():
            if len(text) == 1:
                self.first[ord(text)] = n
            else:
                self.next[number[text[:-1]], self.codes[ord(text[-1])]] = n
            if text in pieces:
                self.ids[n], self.scores[n] = pieces[text]


_UNITS = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")


def units_of(text: str) -> list[str]:
    """The units of a text; those of one line end or one literal U+2581 stand for bytes."""
    if not text:
        return []
    if BLANK in text:
        first, *others = text.split(BLANK)
        out = _UNITS.findall((" " + first).replace(" ", BLANK))
        for part in others:
            out.append(LITERAL)
            out += _UNITS.findall(part.replace(" ", BLANK))
        return out
    return _UNITS.findall((" " + text).replace(" ", BLANK))


#: Stands for U+2581 of the text; no unit of a text is empty.
LITERAL = ""


def bytes_of(unit: str) -> bytes | None:
    """The bytes that a unit without a lattice stands for."""
    return BLANK.encode() if unit == LITERAL else b"\n" if unit == "\n" else None
