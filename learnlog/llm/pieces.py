"""SentencePiece encoding and decoding by a table of distinct marked words.

White space becomes a marker, and no piece of a suitable model holds a marker
after another character, or a line feed. So a text splits into chunks, a run of
markers with the word behind it, or one line feed, that no piece crosses. Each
distinct chunk is segmented once, and ids and decoded texts are joined back by
position. A model with a crossing piece is refused for the table; its texts are
then encoded whole.
"""

import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from learnlog.llm.shared import ChunkTable, map_texts, spans

MARK = "▁"
CHUNK = re.compile(r"\n| *[^ \n]+| +")


def separable(processor) -> bool:
    """Whether no piece crosses a chunk border and normalization leaves texts alone."""
    pieces = [processor.id_to_piece(i) for i in range(processor.vocab_size())]
    if any("\n" in p or re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
        return False
    feed, mark = processor.piece_to_id("<0x0A>"), processor.piece_to_id(MARK)
    known = processor.unk_id()
    probe = "a  ÅÅ é\tﬁ \n b "
    return known not in (feed, mark) and processor.decode(processor.encode(probe)) == probe


@lru_cache(maxsize=2)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def chunks_of(text: str) -> list[str]:
    """The chunks of a text, its added first marker included; an empty text has none."""
    return CHUNK.findall(" " + text.replace(MARK, " ")) if text else []


class _Table(ChunkTable):
    """Chunk to ids as bytes. ``odd``: decoded texts of chunks that decode to something else."""

    def __init__(self, processor):
        super().__init__(self._segment)
        self.processor, self.odd = processor, {}
        self.feed, self.mark = processor.piece_to_id("<0x0A>"), processor.piece_to_id(MARK)

    def _segment(self, chunks: list[str]) -> list[bytes]:
        # The library adds one marker itself, so a marked chunk goes in without its first.
        # A chunk after a line feed has none: it is encoded behind a line feed, cut off again.
        behind = ["\n" + c if c[0] != " " and c != "\n" else c[1:] for c in chunks]
        found = self.processor.encode(behind, num_threads=1)
        joined = [self.feed]
        for i, chunk in enumerate(chunks):
            if chunk == "\n":
                found[i] = [self.feed]
                continue
            if chunk == " ":
                found[i] = [self.mark]
            elif chunk[0] != " ":
                found[i] = found[i][2:]
            joined += found[i]
            joined.append(self.feed)
        # Decoded together; the line feeds keep chunks apart, and the first keeps its marker.
        decoded = self.processor.decode(joined).split("\n")[1:-1]
        words = [c for c in chunks if c != "\n"]
        self.odd.update((c, d) for c, d in zip(words, decoded, strict=True) if c != d)
        return [array("I", ids).tobytes() for ids in found]

    def decoded(self, chunks: list[str]) -> str:
        if self.odd and not self.odd.keys().isdisjoint(chunks):
            chunks = [self.odd.get(c, c) for c in chunks]
        return "".join(chunks)[1:]


@lru_cache(maxsize=2)
def _table(path: str) -> _Table | None:
    """The table of this worker; None if pieces may cross chunks."""
    processor = _processor(path)
    return _Table(processor) if separable(processor) else None


def _compute(path: str, begin: bool, end: bool) -> Callable:
    processor, table = _processor(path), _table(path)
    first = array("I", [processor.bos_id()] * begin).tobytes()
    last = array("I", [processor.eos_id()] * end).tobytes()

    def by_chunk(texts: list[str | None]) -> tuple[list[bytes], list[str]]:
        chunks = [chunks_of(t or "") for t in texts]
        found = table.look_up(list(chain.from_iterable(chunks)))
        ids = [first + b"".join(found[a:b]) + last for a, b in spans(chunks)]
        return ids, list(map(table.decoded, chunks))

    def whole(texts: list[str | None]) -> tuple[list[bytes], list[str]]:
        found = processor.encode([t or "" for t in texts], num_threads=1)
        ids = [first + array("I", f).tobytes() + last for f in found]
        return ids, processor.decode(found, num_threads=1)

    def compute(texts: list[str | None]) -> list[pa.Array]:
        ids, decoded = by_chunk(texts) if table else whole(texts)
        return [pa.array(ids, pa.binary()), pa.array(decoded, pa.string())]

    return compute


def round_trip(
    docs: DataFrame, model_path: str, begin: bool = True, end: bool = True
) -> DataFrame:
    """Encode every whole text and decode its ids again.

    Returns ``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit, with the
    begin and end ids asked for) and ``decoded``. A NULL text is an empty text: it
    has only the begin and end ids and decodes to an empty text. Repeated rows
    and NULL ids stay rows of their own; an empty table gives no rows; other
    columns are not read.
    """
    fields = [("ids", pa.binary()), ("decoded", pa.string())]
    return map_texts(docs, fields, lambda: _compute(model_path, begin, end))


def encode(docs: DataFrame, model_path: str, begin: bool = True, end: bool = True) -> DataFrame:
    """``doc_id`` and ``ids`` of every text, as in :func:`round_trip`."""
    return round_trip(docs, model_path, begin, end).select("doc_id", "ids")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id`` and ``text`` of ``ids`` as :func:`encode` writes them; NULL ids give NULL."""

    def make():
        processor = _processor(model_path)

        def compute(ids: list[bytes | None]) -> list[pa.Array]:
            rows = [None if x is None else np.frombuffer(x, "<u4").tolist() for x in ids]
            texts = [None if row is None else processor.decode(row) for row in rows]
            return [pa.array(texts, pa.string())]

        return compute

    return map_texts(encoded, [("text", pa.string())], make, text="ids")
