"""Recognising audio by first bytes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCAN = 4096


def has_mpeg_header(prefix: bytes | None) -> bool:
    """Whether a valid MPEG audio frame header begins within the first bytes."""
    b = np.frombuffer(bytes(prefix or b"")[: SCAN + 3], np.uint8)
    n = min(len(b) - 3, SCAN)
    if n <= 0:
        return False
    sync, version, rate = b[:n], b[1 : n + 1], b[2 : n + 2]
    ok = (sync == 255) & (version & 224 == 224) & (version & 24 != 8) & (version & 6 != 0)
    return bool((ok & (rate & 240 != 0) & (rate & 240 != 240) & (rate & 12 != 12)).any())


@F.pandas_udf(T.BooleanType())
def _mpeg(prefix: pd.Series) -> pd.Series:
    return prefix.map(has_mpeg_header)


def audio_extension(prefix: Column) -> Column:
    """File extension by signature; null if none is known. The MPEG scan comes before other containers."""
    at = lambda start, size: F.hex(F.substring(prefix, start, size))
    tag = lambda s: s.encode().hex().upper()
    return (
        F.when(at(1, 3) == tag("ID3"), ".mp3").when(_mpeg(F.substring(prefix, 1, SCAN + 3)), ".mp3")
        .when(at(1, 4) == tag("fLaC"), ".flac").when(at(1, 4) == tag("OggS"), ".ogg")
        .when((at(1, 4) == tag("RIFF")) & (at(9, 4) == tag("WAVE")), ".wav")
        .when((at(5, 4) == tag("ftyp")) & at(9, 4).isin(tag("M4A "), tag("M4B ")), ".m4a")
    )
