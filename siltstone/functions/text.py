"""Text columns: path slugs, language folders, display formats, digests."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Device names that no file or folder may have, and names for what is empty.
DEVICES = r"(?:con|prn|aux|nul|com[0-9]|lpt[0-9])"
NO_SLUG, NO_LANGUAGE, NO_TITLE = "inconnue", "langue_inconnue", "audio"
#: White space as Python strips it: Unicode white space and the four separators that Java leaves out.
BLANK = r"(?U)[\s\x1c-\x1f]"


@F.pandas_udf(T.StringType())
def _plain(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


def slug(text: Column, limit: int = 48) -> Column:
    """ASCII letters and digits joined by ``-``, at most limit characters; never empty, never a device name."""
    runs = F.regexp_replace(F.lower(_plain(text)), "[^a-z0-9]+", "-")
    cut = F.regexp_replace(F.substring(F.regexp_replace(runs, "^-+|-+$", ""), 1, limit), "-+$", "")
    return F.when(cut == "", NO_SLUG).when(cut.rlike(f"^{DEVICES}$"), F.concat(F.lit("lang-"), cut)).otherwise(cut)


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, f"{BLANK[:4]}^{BLANK[4:]}+|{BLANK[4:]}+$", "")


def sorted_labels(labels: Column) -> Column:
    """Distinct stripped labels in order, blank ones left out."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.filter(labels, lambda x: x.isNotNull()), strip), lambda x: x != "")))


def language_folder(labels: Column) -> Column:
    """A folder's name for a set of labels."""
    joined = F.array_join(sorted_labels(labels), " + ")
    name = F.when(joined == "", NO_LANGUAGE).otherwise(joined)
    name = F.btrim(F.regexp_replace(name, r'[<>:"/\\|?*\x00-\x1f]', "_"), F.lit(" ."))
    name = F.when(name == "", NO_LANGUAGE).otherwise(name)
    return F.when(name.rlike(rf"(?i)^{DEVICES}(\..*)?$"), F.concat(F.lit("_"), name)).otherwise(name)


def media_path(audio_url: Column, title: Column, labels: Column) -> Column:
    key = F.sha2(audio_url, 256)
    return F.concat(language_folder(labels), F.lit("/"), slug(title, 40), F.lit("__"), F.substring(key, 1, 32))


def state_paths(audio_url: Column) -> tuple[Column, Column]:
    """Names of the checkpoint and of the receipt."""
    key = F.sha2(audio_url, 256)
    return F.concat(F.lit("_state/"), key, F.lit(".partial.json")), F.concat(F.lit("_state/"), key, F.lit(".json"))


def snapshot_name(url: Column) -> Column:
    return F.concat(F.sha2(url, 256), F.lit(".html"))


def format_bytes(n: Column) -> Column:
    n = n.cast("double")
    return F.format_string("%.3f Go (%.3f Gio)", n / 1e9, n / float(1 << 30))


def duration(seconds: Column) -> Column:
    s = F.greatest(F.lit(0), F.floor(seconds)).cast("long")
    part = lambda size, most: (F.floor(s / size) % most if most else F.floor(s / size)).cast("long")
    return F.format_string("%dj %02d:%02d:%02d", part(86400, 0), part(3600, 24), part(60, 60), s % 60)


def progress(done: Column, total: Column, elapsed: Column) -> dict[str, Column]:
    """percent, eta (0 when nothing is left, null when nothing is done) and rate."""
    left = F.greatest(F.lit(0), total - done)
    return {
        "percent": F.when(total == 0, 100.0).otherwise(F.least(F.lit(100.0), F.try_divide(100.0 * done, total))),
        "eta": F.when(left == 0, 0.0).when(done > 0, F.try_divide(elapsed, done) * left),
        "rate": F.try_divide(done, elapsed),
    }


def cut_error(text: Column) -> Column:
    return F.substring(text, 1, 2000)
