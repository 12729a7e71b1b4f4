"""Texts as stretches between spaces, of which each distinct one is encoded once per batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def cut(
    texts: pa.LargeStringArray, whole: np.ndarray
) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """Distinct stretches, uncut texts, the stretch at each place and where each text begins.

    Texts marked ``whole`` are not cut; they are numbered behind the stretches. The last entry of
    the beginnings is the end.
    """
    lists = pc.split_pattern(pc.if_else(pa.array(~whole), texts, pa.scalar("", texts.type)), " ")
    begins = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    places = coded.indices.to_numpy().astype(np.int64)
    uncut = texts.filter(pa.array(whole)).to_pylist()
    places[begins[:-1][whole]] = len(distinct) + np.arange(len(uncut))
    return distinct, uncut, places, begins


def spread(
    parts: list[bytes], places: np.ndarray, begins: np.ndarray, lost: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts behind each other, and how many each text has.

    ``parts`` has the ids of each stretch as 32-bit numbers. A text with a ``lost`` stretch has none.
    """
    size = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
    at = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(parts), "<u4")
    n = size[places]
    if lost is not None and lost.any():
        hit = np.concatenate([np.zeros(1, np.int64), np.cumsum(lost[places])])
        n[np.repeat(np.diff(hit[begins]) > 0, np.diff(begins))] = 0
    stop = np.cumsum(n)
    place = np.repeat(at[places] - (stop - n), n) + np.arange(n.sum())
    total = np.concatenate([np.zeros(1, np.int64), stop])
    return flat[place], np.diff(total[begins])
