"""Piece vocabularies of public tokenizer files, and cuts no piece crosses."""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass, field

SPACE = "▁"  # the visible space of piece vocabularies (fixed value)


@dataclass(frozen=True)
class Vocabulary:
    """Text pieces with their ids and scores, and the ids of the 256 byte pieces."""

    ids: dict[str, int]
    scores: dict[str, float]
    pieces: list[str] = field(repr=False)
    byte_ids: list[int]
    unknown_id: int
    end_id: int
    controls: frozenset[int]

@functools.lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    special = {i for i in range(len(pieces)) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
    text = [i for i in range(len(pieces)) if i not in special and not sp.is_byte(i)]
    return Vocabulary({pieces[i]: i for i in text}, {pieces[i]: sp.get_score(i) for i in text}, pieces, byte_ids,
                      sp.unk_id(), sp.eos_id(), frozenset(i for i in special if sp.is_control(i)))


def escape(text: str) -> str:
    """Spaces made visible, and the dummy one in front; nothing for an empty text."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def splitter(vocabulary: Vocabulary, cut_spaces: bool = False):
    """A function that cuts an escaped text where no piece can reach across.

    Cuts stand before a run of spaces that follows anything else (no piece
    holds a space after another character; checked here) and around
    characters that no piece of two or more characters holds.  Tokens of a
    text are therefore the tokens of its parts.  ``cut_spaces`` also cuts a
    run of spaces before its last one where a word follows.
    """
    if any(SPACE in p.lstrip(SPACE) for p in vocabulary.ids):
        raise ValueError("a piece holds a space behind other characters; parts would not be independent")
    inner = {c for p in vocabulary.ids if len(p) > 1 for c in p} - {SPACE}
    if not (inner | {SPACE}) <= vocabulary.ids.keys():
        raise ValueError("a character of a longer piece has no piece of its own")
    held = "".join(re.escape(c) for c in sorted(inner))
    word = f"{SPACE}?[{held}]+|{SPACE}+(?={SPACE}[{held}])" if cut_spaces else f"{SPACE}*[{held}]+"
    return re.compile(f"{word}|{SPACE}+|[^{SPACE}]").findall
