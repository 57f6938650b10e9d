"""Colour and contrast expressions; channels are 0 to 255."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def luminance(r: Column, g: Column, b: Column) -> Column:
    """Relative luminance of sRGB."""

    def linear(c: Column) -> Column:
        s = c / 255.0
        return F.when(s <= 0.04045, s / 12.92).otherwise(F.pow((s + 0.055) / 1.055, F.lit(2.4)))

    return 0.2126 * linear(r) + 0.7152 * linear(g) + 0.0722 * linear(b)


def contrast(a: Column, b: Column) -> Column:
    """Ratio of two luminances, 1 to 21."""
    return (F.greatest(a, b) + 0.05) / (F.least(a, b) + 0.05)


def hex_channels(color: Column) -> Column:
    """struct(r, g, b) of #rgb or #rrggbb; null otherwise."""
    digits = F.lower(F.regexp_extract(F.trim(color), r"^#([0-9a-fA-F]{6}|[0-9a-fA-F]{3})$", 1))
    six = F.when(F.length(digits) == 3, F.regexp_replace(digits, "(.)", "$1$1")).otherwise(digits)
    parts = [F.conv(F.substring(six, i, 2), 16, 10).cast("int").alias(n) for i, n in ((1, "r"), (3, "g"), (5, "b"))]
    return F.when(F.length(six) == 6, F.struct(*parts))


def rgb_channels(color: Column) -> Column:
    """struct(r, g, b) of rgb(r, g, b); null otherwise."""
    found = [F.regexp_extract(F.lower(color), r"^\s*rgba?\(\s*(\d{1,3})\s*,\s*(\d{1,3})\s*,\s*(\d{1,3})", i) for i in (1, 2, 3)]
    return F.when(found[0] != "", F.struct(*[f.try_cast("int").alias(n) for f, n in zip(found, "rgb", strict=True)]))


def channels(color: Column) -> Column:
    return F.coalesce(hex_channels(color), rgb_channels(color))


def to_hex(r: Column, g: Column, b: Column) -> Column:
    return F.format_string("#%02x%02x%02x", r.cast("int"), g.cast("int"), b.cast("int"))


def int_channels(value: Column) -> Column:
    return F.struct(*[F.shiftright(value, n).bitwiseAND(255).alias(c) for n, c in ((16, "r"), (8, "g"), (0, "b"))])


def cmyk_channels(c: Column, m: Column, y: Column, k: Column) -> Column:
    return F.struct(*[F.round(255 * (1 - x) * (1 - k)).cast("int").alias(n) for x, n in ((c, "r"), (m, "g"), (y, "b"))])


def gray_channels(g: Column) -> Column:
    v = F.round(255 * g).cast("int")
    return F.struct(v.alias("r"), v.alias("g"), v.alias("b"))


def is_large(points: Column, bold: Column) -> Column:
    return (points >= 18) | ((points >= 14) & bold)


def threshold(large: Column, level: Column) -> Column:
    """Least contrast for text: AA 4.5 or 3 if large, AAA 7 or 4.5."""
    return F.when(F.upper(level) == "AAA", F.when(large, 4.5).otherwise(7.0)).otherwise(F.when(large, 3.0).otherwise(4.5))


def hue_weights(r: Column, g: Column, b: Column) -> tuple[Column, list[Column]]:
    """Saturation of a colour (channels 0 to 1, hue, lightness, saturation model), and how far each channel is on the way from the least to the greatest; both stay as lightness changes."""
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    span, total = high - low, high + low
    saturation = F.when(span == 0, 0.0).when(total <= 1, span / total).otherwise(span / (2.0 - high - low))  # 2 - total rounds: full saturation would come out beside 1
    far = [(high - c) / span for c in (r, g, b)]
    turn = F.when(r == high, far[2] - far[1]).when(g == high, 2.0 + far[0] - far[2]).otherwise(4.0 + far[1] - far[0]) / 6.0

    def weight(shift: float) -> Column:
        h = F.pmod(turn + shift, F.lit(1.0))
        return F.when(span == 0, 0.0).when(h < 1 / 6, h * 6.0).when(h < 0.5, 1.0).when(h < 2 / 3, (2 / 3 - h) * 6.0).otherwise(0.0)

    return saturation, [weight(1 / 3), weight(0.0), weight(-1 / 3)]


def at_lightness(saturation: Column, weights: list[Column], lightness: Column) -> list[Column]:
    """Channels, 0 to 1, of the colour of that hue and saturation at another lightness."""
    top = F.when(lightness <= 0.5, lightness * (1.0 + saturation)).otherwise(lightness + saturation - lightness * saturation)
    low = 2.0 * lightness - top
    return [low + (top - low) * w for w in weights]


def named(**columns: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in columns.items()])


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def nearest_passing(r: Column, g: Column, b: Column, bg_r: Column, bg_g: Column, bg_b: Column, least: float = 4.5, steps: int = 64, away: bool = False) -> Column:
    """struct(r, g, b), whole channels: the colour of the same hue and saturation nearest in lightness whose contrast with the background is ``least``, by bisection inside the row.

    On backgrounds lighter than a luminance of 0.5 darker colours are tried, on others lighter ones; black or white if none passes. A colour that passes stays.
    ``away`` halves the other way, from what passes on to what passes better, and so ends at black or white: the rule of tools that store such results.
    """
    back = luminance(bg_r, bg_g, bg_b)
    darken = back > 0.5
    saturation, weights = hue_weights(*[c / 255.0 for c in (r, g, b)])
    fixed = F.struct(saturation.alias("s"), *[w.alias(f"w{k}") for k, w in enumerate(weights)], back.alias("back"), darken.alias("darken"))
    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"), F.when(darken, 0.0).otherwise(1.0).alias("best"), fixed.alias("f"))

    def halve(x: Column, _: Column) -> Column:
        f, mid = x["f"], (x["lo"] + x["hi"]) / 2
        lit = named(mid=mid, top=F.when(mid <= 0.5, mid * (1.0 + f["s"])).otherwise(mid + f["s"] - mid * f["s"]))
        shown = once(lit, lambda m: named(mid=m["mid"], **{f"c{k}": 255.0 * (2.0 * m["mid"] - m["top"] + 2.0 * (m["top"] - m["mid"]) * f[f"w{k}"]) for k in range(3)}))
        lum = once(shown, lambda c: named(mid=c["mid"], n=luminance(c["c0"], c["c1"], c["c2"])))
        # on passing back towards the original colour, and else on towards black or white
        tried = once(lum, lambda n: named(mid=n["mid"], ok=contrast(n["n"], f["back"]) >= least))
        up = lambda t: (t["ok"] == f["darken"]) if away else (t["ok"] != f["darken"])
        return once(tried, lambda t: named(lo=F.when(up(t), x["lo"]).otherwise(t["mid"]), hi=F.when(up(t), t["mid"]).otherwise(x["hi"]), best=F.when(t["ok"], t["mid"]).otherwise(x["best"]), f=f))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda x: named(l=x["best"], f=x["f"]))
    # whole channels on the side that passes
    whole = lambda c: F.greatest(F.lit(0), F.least(F.lit(255), F.when(darken, F.floor(255.0 * c)).otherwise(F.ceil(255.0 * c)))).cast("int")
    new = once(found, lambda x: named(**{n: whole(c) for n, c in zip("rgb", at_lightness(x["f"]["s"], [x["f"][f"w{k}"] for k in range(3)], x["l"]), strict=True)}))
    passes = contrast(luminance(r, g, b), back) >= least
    return F.when(passes, named(r=r.cast("int"), g=g.cast("int"), b=b.cast("int"))).otherwise(new)


def with_nearest_passing(rows: DataFrame, name: str, pair: list[Column], least: float = 4.5, away: bool = False) -> DataFrame:
    """Adds ``name``, the nearest passing colour of a pair of colours (channels r, g, b of the text, then of what lies behind); null where one is null.

    Each pair is looked for once, however many rows have it, and the pairs are dealt over tasks: few bytes are much work here.
    """
    keys = [f"_{name}_{k}" for k in range(6)]
    rows = rows.withColumns(dict(zip(keys, pair, strict=True)))
    tasks = 4 * rows.sparkSession.sparkContext.defaultParallelism
    pairs = rows.select(*keys).distinct().na.drop().repartition(tasks, *keys)
    found = pairs.withColumn(name, nearest_passing(*map(F.col, keys), least=least, away=away))
    return rows.join(found, keys, "left").drop(*keys)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
