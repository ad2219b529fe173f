"""Token ids of whole texts with a public tokenizer, inside tasks, in bounded memory."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers

# Characters of a part of a long text, and of texts looked up together; chunks encoded together.
_PART = 1 << 17
_BATCH = 1 << 18
_TOGETHER = 4096
# Chunks whose ids are remembered: those met once, and those met again.
_ONCE = 50_000
_AGAIN = 100_000
_SHORT = 64
# A single space between two visible characters: word tokenizers always part there.
_CHUNK = re.compile(r"(?<=\S)(?= \S)")
# White space other than space and line end.
_RARE = re.compile(r"[^\S \n]")
_SEAM = re.compile(r"(?<=[^\W_]) (?=[^\W_])")


@lru_cache(maxsize=4)
def _tokenizer(name: str):
    # Spark runs a task per core; threads of their own only take memory there.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def vocabulary(name: str) -> int:
    """Number of ids a tokenizer knows."""
    return _tokenizer(name).get_vocab_size()


def _parts(text: str) -> Iterator[str]:
    """The text in parts that tokenize like the whole; each later part starts with its space."""
    start = 0
    while len(text) - start > _PART:
        seam = _SEAM.search(text, start + _PART)
        if seam is None:
            break
        yield text[start : seam.start()]
        start = seam.start()
    yield text[start:]


def _chunks(text: str) -> list[str]:
    """The text cut before each single space between visible characters, without that space.

    The first chunk is the one that has none.
    """
    beside = "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
    if not beside and _RARE.search(text) is None:
        return text.split(" ")
    first, *later = _CHUNK.split(text)
    return [first, *(chunk[1:] for chunk in later)]


class _Lookup:
    """Ids of chunks with a space before them, encoded once while they are remembered.

    Most chunks of a large corpus occur once or twice. Those are soon let go of; the others
    move to a memory of their own. ``forget`` empties both, as a Python worker outlives its
    tasks; the tokenizer stays, since loading it again and again costs more than it takes.
    """

    def __init__(self, name: str):
        self.tokenizer = _tokenizer(name)
        self.again: dict[str, bytes] = {}
        self.once: dict[str, bytes] = {}

    def learn(self, texts: list[list[str]]) -> dict[str, bytes]:
        """The ids of all chunks of the texts but the first of each."""
        wanted: set[str] = set()
        for chunks in texts:
            wanted.update(islice(chunks, 1, None))
        held, once, again = {}, self.once, self.again
        new = []
        for chunk in wanted:
            ids = again.get(chunk)
            if ids is None:
                ids = once.pop(chunk, None)
                if ids is None:
                    new.append(chunk)
                    continue
                again[chunk] = ids
            held[chunk] = ids
        spaced = [f" {chunk}" for chunk in new]
        fresh = dict(zip(new, self.bare(spaced), strict=True))
        held |= fresh
        once.update((chunk, ids) for chunk, ids in fresh.items() if len(chunk) <= _SHORT)
        for memory, most in ((once, _ONCE), (again, _AGAIN)):
            if len(memory) > most:
                for chunk in list(islice(memory, len(memory) - most // 2)):
                    del memory[chunk]
        return held

    def bare(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as they are."""
        return [
            array("I", one.ids).tobytes()
            for at in range(0, len(texts), _TOGETHER)
            for one in self.tokenizer.encode_batch_fast(
                texts[at : at + _TOGETHER], add_special_tokens=False
            )
        ]


@lru_cache(maxsize=4)
def _lookup(name: str) -> _Lookup:
    return _Lookup(name)


def forget(name: str) -> None:
    """For the end of a task: let go of what its texts were encoded to."""
    _lookup(name).once.clear()
    _lookup(name).again.clear()


def token_ids(texts, name: str, end: int) -> Iterator[np.ndarray]:
    """Ids of each text with the end id, in order; a NULL text counts as empty.

    The ids are those of the tokenizer as it is loaded: the strings of its special tokens,
    where a text holds them, become those tokens. Tokenizers of this kind never join across
    a single space between visible characters. So each different chunk between such spaces
    is encoded once.
    """
    lookup = _lookup(name)
    last = np.array([end], "<u4").tobytes()
    waiting: list[list[str]] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        known = lookup.learn(waiting)
        firsts = lookup.bare([chunks[0] for chunks in waiting])
        for first, chunks in zip(firsts, waiting, strict=True):
            later = map(known.__getitem__, islice(chunks, 1, None))
            yield np.frombuffer(b"".join([first, *later, last]), "<u4")
        waiting.clear()

    def long(text: str) -> Iterator[bytes]:
        for number, part in enumerate(_parts(text)):
            chunks = _chunks(part) if number == 0 else ["", *_chunks(part[1:])]
            known = lookup.learn([chunks])
            if number == 0:
                yield lookup.bare(chunks[:1])[0]
            yield b"".join(map(known.__getitem__, islice(chunks, 1, None)))

    for text in texts:
        text = text or ""
        if len(text) > _BATCH:
            yield from flush()
            size = 0
            yield np.frombuffer(b"".join([*long(text), last]), "<u4")
            continue
        waiting.append(_chunks(text))
        size += len(text) + 100
        if size > _BATCH:
            yield from flush()
            size = 0
    yield from flush()
