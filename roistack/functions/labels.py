"""Labels of measurement tables: tokens, slice numbers, naming columns by content, ROI names, colours."""

from __future__ import annotations

import re
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Token names and the patterns that all values of a token column must match.
TOKEN_PATTERNS = {"filename": r"\.lif$", "roi": r"\d{4}-\d{4}-\d{4}$", "pos": r"^[Pp]osition\d+$"}
#: Fixed value: what stands between the tokens of a label.
SEPARATORS = r"[/:]|\s+"
#: The qualitative palettes of ColorBrewer, by name.
PALETTES = {
    "Accent": ["#7FC97F", "#BEAED4", "#FDC086", "#FFFF99", "#386CB0", "#F0027F", "#BF5B17", "#666666"],
    "Dark2": ["#1B9E77", "#D95F02", "#7570B3", "#E7298A", "#66A61E", "#E6AB02", "#A6761D", "#666666"],
    "Paired": ["#A6CEE3", "#1F78B4", "#B2DF8A", "#33A02C", "#FB9A99", "#E31A1C", "#FDBF6F", "#FF7F00", "#CAB2D6", "#6A3D9A", "#FFFF99", "#B15928"],
    "Pastel1": ["#FBB4AE", "#B3CDE3", "#CCEBC5", "#DECBE4", "#FED9A6", "#FFFFCC", "#E5D8BD", "#FDDAEC", "#F2F2F2"],
    "Pastel2": ["#B3E2CD", "#FDCDAC", "#CBD5E8", "#F4CAE4", "#E6F5C9", "#FFF2AE", "#F1E2CC", "#CCCCCC"],
    "Set1": ["#E41A1C", "#377EB8", "#4DAF4A", "#984EA3", "#FF7F00", "#FFFF33", "#A65628", "#F781BF", "#999999"],
    "Set2": ["#66C2A5", "#FC8D62", "#8DA0CB", "#E78AC3", "#A6D854", "#FFD92F", "#E5C494", "#B3B3B3"],
    "Set3": ["#8DD3C7", "#FFFFB3", "#BEBADA", "#FB8072", "#80B1D3", "#FDB462", "#B3DE69", "#FCCDE5", "#D9D9D9", "#BC80BD", "#CCEBC5", "#FFED6F"],
}
PAIRED = PALETTES["Paired"]
#: The greys of invalid features and of failed ROIs.
INVALID_COLOUR, FAILED_COLOUR = "gray40", "gray80"


def tokens(label: Column) -> Column:
    """Parts of a label between slashes, white space and colons."""
    return F.split(label, SEPARATORS)


def slice_number(label: Column) -> Column:
    """The number after the first ``z:``, null without one."""
    return F.nullif(F.regexp_extract(label, r"(?<=z:)\d+", 0), F.lit("")).cast("int")


def channel_number(label: Column) -> Column:
    return F.nullif(F.regexp_extract(label, r"(?<=c:)\d+", 0), F.lit("")).cast("int")


def roi_type(roi: Column) -> Column:
    """The letters that a ROI's name begins with."""
    return F.nullif(F.regexp_extract(roi, r"^\p{IsAlphabetic}+", 0), F.lit(""))


def clean_name(name: str) -> str:
    """A column's name without trailing dots, in lower case."""
    return re.sub(r"\.+$", "", name).lower()


def position_part(label: Column) -> Column:
    """The first part between slashes that names a position."""
    return F.get(F.filter(F.split(label, "/"), lambda x: x.contains("Position")), F.lit(0))


def renamed(index: Column, roi: Column, lo: int, hi: int, prefix: str = "", suffix: str = "") -> Column:
    """ROI names with prefix and suffix where lo <= index < hi."""
    return F.when((index >= lo) & (index < hi), F.concat(F.lit(prefix), roi, F.lit(suffix))).otherwise(roi)


def name_by_content(df: DataFrame, columns: list[str], patterns: dict[str, str] = TOKEN_PATTERNS) -> dict[str, str]:
    """New names of columns whose values, nulls aside, all match a pattern.

    Of several columns for one name the first has the name itself and the others ``_1``, ``_2`` and so on;
    a column for several names takes the last; either is warned of.  One aggregation; a column without values matches
    nothing.
    """
    checks = [F.bool_and(F.col(c).rlike(p)).alias(f"{c}|{n}") for c in columns for n, p in patterns.items()]
    row = df.agg(*checks).first() if checks else {}
    return _names({name: [c for c in columns if row[f"{c}|{name}"]] for name in patterns})


def _names(hits: dict[str, list[str]]) -> dict[str, str]:
    """New names of columns, from the columns that match each name's pattern."""
    out: dict[str, str] = {}
    for name, own in hits.items():
        out.update({c: name if k == 0 else f"{name}_{k}" for k, c in enumerate(own)})
    taken = [c for own in hits.values() for c in own]
    for what, found in (("columns that match several patterns", sorted({c for c in taken if taken.count(c) > 1})), ("patterns that several columns match", [n for n, own in hits.items() if len(own) > 1])):
        if found:
            warnings.warn(f"{what}: {', '.join(found)}", stacklevel=3)
    return out


def parse_labels(df: DataFrame, label: str = "label", patterns: dict[str, str] = TOKEN_PATTERNS) -> DataFrame:
    """``df`` with its labels' named tokens and slice number; tokens without a name are left out.

    One look at the labels tells which patterns the tokens of each place match.  A label without a token at a place has an empty one there.
    """
    matched = lambda x: sum((F.when(x.rlike(p), 1 << k).otherwise(0) for k, p in enumerate(patterns.values())), F.lit(0))
    places = df.select(F.posexplode_outer(F.transform(tokens(F.col(label)), matched)).alias("place", "mask"))
    found = places.groupBy("place").agg(F.count("*").alias("n"), F.bit_and("mask").alias("mask"), F.first(matched(F.lit(""))).alias("empty")).collect()
    labels = sum(r["n"] for r in found if not r["place"])
    masks = {r["place"]: r["mask"] if r["n"] == labels else r["mask"] & r["empty"] for r in found if r["place"] is not None}
    parts = [f"V{k + 1}" for k in range(len(masks))]
    named = _names({name: [p for k, p in enumerate(parts) if masks[k] >> bit & 1] for bit, name in enumerate(patterns)})
    mine = tokens(F.col(label))
    found = {new: F.coalesce(F.get(mine, F.lit(parts.index(p))), F.lit("")) for p, new in named.items()}
    return df.withColumns({**found, "z": slice_number(F.col(label))})


def palette(n: int, max_repeat: int = 10, literal: bool = False, name: str = "Paired") -> list[str]:
    """``n`` recycled colours of a palette; ``literal``: ``max_repeat`` times the first of them, at most ``n``."""
    if name not in PALETTES:
        raise ValueError(f"{name} is none of {', '.join(PALETTES)}")
    colours = PALETTES[name]
    own = colours[: min(n, len(colours))]
    return own * max_repeat if literal and n > 0 else [colours[k % len(colours)] for k in range(n)]


def palette_colour(rank: Column, name: str = "Paired") -> Column:
    """Colour of a rank from 1, recycled."""
    return F.element_at(F.array(*map(F.lit, PALETTES[name])), (F.pmod(rank - 1, F.lit(len(PALETTES[name]))) + 1).cast("int"))


def feature_colour(feature_id: Column, rank: Column, invalid_prefix: str = "invalid_feature_", failed_prefix: str = "failed_ROI_") -> Column:
    return F.when(feature_id.startswith(failed_prefix), FAILED_COLOUR).when(feature_id.startswith(invalid_prefix), INVALID_COLOUR).otherwise(palette_colour(rank))
