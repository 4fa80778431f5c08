"""Passages of benchmark items in documents, found by an Aho-Corasick automaton."""

from __future__ import annotations

import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.llm import words
from netsieve.llm.columns import add_columns, position
from netsieve.llm.store import stored

WIDTH = 10
# Bytes of windows that one automaton holds; more windows are dealt over several.
AUTOMATON_BYTES = 32_000_000

_NORMAL = np.where(words.ALNUM[words.lower(np.arange(256, dtype=np.uint8))], words.lower(np.arange(256, dtype=np.uint8)), 0x20)
_NORMAL = _NORMAL.astype(np.uint8).tobytes()
_ADDED = "n_words long, hit_words array<int>, items array<string>, spans array<struct<begin:long,end:long>>"
_BUILT: dict = {}


def find_passages(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH
) -> DataFrame:
    """``docs`` with ``n_words, hit_words, items, spans``.

    Words are runs of digits, letters and characters beyond ASCII, with A to Z in lower
    case. A window is ``width`` consecutive words of an item; an item with fewer, but not
    none, is one window. ``hit_words`` has the numbers of the words inside any occurrence of
    a window, ``items`` the ids (as sorted strings) of items with occurring windows, and
    ``spans`` the runs of hit words as character offsets in the original text.

    All windows form one automaton, which reads each text once; word borders are blanks of
    the normalised text and part of the patterns. The windows are broadcast only up to
    ``AUTOMATON_BYTES``: a larger benchmark is dealt over several automata by the hash of
    window and item, and each reads the result of the one before.

    Null and empty texts have no words and no hits. Items without text have no window; hits
    of an item without an id count, but it is not listed. Repeated rows are judged each on
    its own. An empty benchmark hits nothing. Columns named like a result give way to it.
    """
    at = position(docs, text_col)
    none = lambda batch: _nothing(batch, at)
    result = add_columns(docs, none, _ADDED)
    windows, n = _dealt(items, item_id_col, item_text_col, width)
    for k in range(n):
        if k:
            result = stored(result, "scanned")
            sent.unpersist()
            del sent  # the driver holds one part at a time
        sent = docs.sparkSession.sparkContext.broadcast(_part(windows, k))
        result = add_columns(result if k else docs, _scanner(sent, at, k), _ADDED)
    return result


def _windows(width):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            out = []
            for item, text in zip(ids, texts, strict=True):
                found = (text or b"").translate(_NORMAL).split()
                for k in range(max(len(found) - width + 1, min(len(found), 1))):
                    out.append((b" ".join(found[k : k + width]), item))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())], ["window", "item"]
            )

    return run


def _dealt(items, id_col, text_col, width) -> tuple[DataFrame, int]:
    """The distinct windows with their items, each with its part, and the number of parts."""
    rows = items.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    rows = stored(rows.mapInArrow(_windows(width), "window binary, item string").distinct(), "windows")
    size = rows.agg(F.sum(F.length("window") + 24)).first()[0] or 0
    n = -(-size // AUTOMATON_BYTES)
    part = F.pmod(F.xxhash64("window", "item"), F.lit(max(n, 1)))
    return rows.withColumn("part", part), n


def _part(windows: DataFrame, k: int) -> list[tuple[bytes, str | None]]:
    """One part, of bounded size, on the driver."""
    return [tuple(r) for r in windows.where(F.col("part") == k).select("window", "item").collect()]


def _automaton(sent, key):
    """The automaton of a broadcast list; a worker keeps the last one that it built."""
    if key not in _BUILT:
        owners: dict[bytes, set] = {}
        for window, item in sent.value:
            owners.setdefault(bytes(window), set()).add(item)
        found = ahocorasick.Automaton()
        for window, its in owners.items():
            pattern = f" {window.decode('latin-1')} "
            found.add_word(pattern, (pattern.count(" ") - 1, tuple(its)))
        if owners:
            found.make_automaton()
        _BUILT.clear()
        _BUILT[key] = found
    return _BUILT[key]


def _nothing(batch, at):
    texts = [(x or b"").translate(_NORMAL).split() for x in batch.column(at).cast(pa.binary()).to_pylist()]
    return _arrays([(len(x), [], set(), []) for x in texts])


def _arrays(rows):
    return [
        pa.array([r[0] for r in rows], pa.int64()),
        pa.array([r[1] for r in rows], pa.list_(pa.int32())),
        pa.array([sorted(r[2]) for r in rows], pa.list_(pa.string())),
        pa.array([r[3] for r in rows], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
    ]


def _scanner(sent, at, again):
    key = uuid.uuid4().hex

    def scan(batch):
        automaton = _automaton(sent, key)
        earlier = [set()] * batch.num_rows, [set()] * batch.num_rows
        if again:
            earlier = tuple([set(x) for x in batch.column(batch.schema.get_field_index(c)).to_pylist()] for c in ("hit_words", "items"))
        rows = []
        for text, hits, items in zip(batch.column(at).cast(pa.binary()).to_pylist(), *earlier, strict=True):
            found = (text or b"").translate(_NORMAL).split()
            new_hits, new_items = _hits(automaton, found)
            hits, items = sorted(hits | new_hits), items | new_items
            rows.append((len(found), hits, items, _spans(text, hits) if hits else []))
        return _arrays(rows)

    return scan


def _hits(automaton, found: list[bytes]) -> tuple[set, set]:
    hits, items = set(), set()
    line = (b" " + b" ".join(found) + b" ").decode("latin-1") if found else ""
    word, seen, begin, marked = 0, 0, 0, 0  # all words from begin up to marked are hit
    for end, (n, its) in automaton.iter(line) if len(automaton) else ():
        word += line.count(" ", seen, end)  # words that end before this blank
        seen = end
        first = word - n
        hits.update(range(marked if begin <= first <= marked else first, word))
        begin = begin if begin <= first <= marked else first
        marked = word
        items.update(its)
    return hits, items - {None}


def _spans(text: bytes, hits: list[int]) -> list[tuple[int, int]]:
    """Runs of hit words as character offsets of the original text."""
    data = np.frombuffer(text, dtype=np.uint8)
    starts, ends, _ = words.split(words.lower(data), np.array([0, len(data)]), words.ALNUM)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    hits = np.array(hits)
    breaks = np.flatnonzero(np.diff(hits) > 1)
    first, last = hits[np.concatenate([[0], breaks + 1])], hits[np.concatenate([breaks, [len(hits) - 1]])]
    return list(zip(chars[starts[first]].tolist(), chars[ends[last]].tolist(), strict=True))
