"""Per-image geometry of detections as array expressions.

A detection is a struct of label, bbox (x1, y1, x2, y2 in pixels), confidence,
depth_value, position, depth_rank, area_rank and free_space.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the scene model.
LEFT, RIGHT = 0.35, 0.65
NEAR, FAR = 0.33, 0.67
MARGIN = 0.25
IOU_MOST, CONTAINED_MOST = 0.5, 0.8
UNRANKED = 9999


def x_of(box: Column, i: int) -> Column:
    return F.get(box, F.lit(i))


def area(box: Column) -> Column:
    return (x_of(box, 2) - x_of(box, 0)) * (x_of(box, 3) - x_of(box, 1))


def has_box(d: Column) -> Column:
    return F.coalesce(F.size(d["bbox"]) == 4, F.lit(False))


def intersection(a: Column, b: Column) -> Column:
    w = F.least(x_of(a, 2), x_of(b, 2)) - F.greatest(x_of(a, 0), x_of(b, 0))
    h = F.least(x_of(a, 3), x_of(b, 3)) - F.greatest(x_of(a, 1), x_of(b, 1))
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    cross = intersection(a, b)
    return F.when(cross <= 0, 0.0).otherwise(F.try_divide(cross, area(a) + area(b) - cross))


def containment(small: Column, large: Column) -> Column:
    """The part of small that lies in large."""
    return F.when(area(small) <= 0, 0.0).otherwise(F.try_divide(intersection(small, large), area(small)))


def label_words(label: Column) -> Column:
    return F.filter(F.split(F.lower(label), r"\s+"), lambda x: x != "")


def share_a_word(a: Column, b: Column) -> Column:
    return F.coalesce(F.arrays_overlap(label_words(a), label_words(b)), F.lit(False))


def horizontal(box: Column, width: Column) -> Column:
    c = (x_of(box, 0) + x_of(box, 2)) / 2 / width
    return F.when(c < LEFT, "left").when(c > RIGHT, "right").otherwise("center")


def vertical(depth: Column) -> Column:
    return F.when(depth.isNull(), "unknown").when(depth < NEAR, "near").when(depth < FAR, "mid").otherwise("far")


def position(*parts: Column) -> Column:
    """The non-empty parts joined by a dash; unknown if there is none."""
    joined = F.concat_ws("-", *[F.when(p != "", p) for p in parts])
    return F.when(joined == "", "unknown").otherwise(joined)


def clamped_box(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """Normalised centre and size to corners in pixels within the image."""
    inside = lambda v, most: F.greatest(F.lit(0.0), F.least(v, most))
    return F.array(inside((cx - w / 2) * width, width), inside((cy - h / 2) * height, height), inside((cx + w / 2) * width, width), inside((cy + h / 2) * height, height))


def crop_box(box: Column, width: Column, height: Column, pad: float = 0.05) -> Column:
    """The box widened on each side by pad of the image's size, cut to whole pixels inside the image."""
    dx, dy = width * pad, height * pad
    low = lambda v: F.greatest(F.lit(0), v.cast("int"))
    high = lambda v, most: F.least(most.cast("int"), v.cast("int"))
    return F.array(low(x_of(box, 0) - dx), low(x_of(box, 1) - dy), high(x_of(box, 2) + dx, width), high(x_of(box, 3) + dy, height))


def crop_kept(crop: Column, width: Column, height: Column, least: float = 0.002) -> Column:
    """Whether the crop has an area, of at least that part of the image."""
    w, h = x_of(crop, 2) - x_of(crop, 0), x_of(crop, 3) - x_of(crop, 1)
    return (w > 0) & (h > 0) & (w * h / (width * height) >= least)


def rounded(value: Column, digits: int = 4) -> Column:
    """The exact binary value rounded to digits, ties to even; for numbers below 1,000."""
    return F.format_number(value, digits).cast("double")


def median_in(values: Column, mask: Column) -> Column:
    """The median of the values where the mask is true; of all values where it never is."""
    inside = F.transform(F.filter(F.arrays_zip(values.alias("v"), mask.alias("m")), lambda x: x["m"]), lambda x: x["v"])
    ordered = F.sort_array(F.when(F.size(inside) > 0, inside).otherwise(values))
    n = F.size(ordered)
    return (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2


def normalised_depths(depths: Column) -> Column:
    """Inverted to 0 = nearest, 1 = farthest; all 1 where every value is the same."""
    low, high = F.array_min(depths), F.array_max(depths)
    return F.transform(depths, lambda d: F.lit(1.0) - F.coalesce(F.try_divide(d.cast("double") - low, high.cast("double") - low), F.lit(0.0)))


def let(value: Column, body) -> Column:
    """body of the value, which is worked out once however often body, or a lambda in it, reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _ordered(dets: Column, key) -> Column:
    """The detections sorted by the key, which is never null, stably."""
    return F.transform(F.sort_array(F.transform(dets, lambda d, i: F.struct(key(d).alias("k"), i.alias("i"), d.alias("d")))), lambda x: x["d"])


def by_rank(dets: Column, name: str = "depth_rank") -> Column:
    """Unset ranks, 0 or null, come last."""
    return _ordered(dets, lambda d: F.coalesce(F.nullif(d[name], F.lit(0)), F.lit(UNRANKED)))


def _suppressed(x: Column, by: Column) -> Column:
    """Whether the box x falls to a box by, both as survivors holds them."""
    w = F.least(x["x2"], by["x2"]) - F.greatest(x["x1"], by["x1"])
    h = F.least(x["y2"], by["y2"]) - F.greatest(x["y1"], by["y1"])

    def over(cross: Column) -> Column:
        within = (x["a"] > 0) & (F.try_divide(cross, x["a"]) > CONTAINED_MOST) & share_a_word(x["d"]["label"], by["d"]["label"])
        return (cross > 0) & (F.coalesce(F.try_divide(cross, x["a"] + by["a"] - cross) > IOU_MOST, F.lit(False)) | F.coalesce(within, F.lit(False)))

    return by["box"] & F.exists(F.array(F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))), over)


def survivors(dets: Column, kind: str) -> Column:
    """Greedy suppression from the largest box down; what has no box stays and suppresses nothing.

    A box falls only to a box that was kept, so the fold carries the kept ones,
    each beside its corners and area.
    """

    def keyed(d: Column, i: Column) -> Column:
        corners = [x_of(d["bbox"], k).alias(n) for k, n in enumerate(("x1", "y1", "x2", "y2"))]
        key = F.coalesce(F.when(has_box(d), -area(d["bbox"])), F.lit(0.0))
        return F.struct(key.alias("k"), i.alias("i"), has_box(d).alias("box"), area(d["bbox"]).alias("a"), *corners, d.alias("d"))

    held = f"array<struct<k:double,i:int,box:boolean,a:double,x1:double,y1:double,x2:double,y2:double,d:{kind[len('array<'):-1]}>>"
    falls = lambda kept, x: x["box"] & F.exists(kept, lambda k: _suppressed(x, k))
    add = lambda kept, x: F.when(falls(kept, x), kept).otherwise(F.concat(kept, F.array(x)))
    return F.transform(F.aggregate(F.sort_array(F.transform(dets, keyed)), F.array().cast(held), add), lambda x: x["d"])


def top(dets: Column, n: int = 25) -> Column:
    """The n largest by area rank as it stands, stably, only if there are more; a list with an unranked one stays whole."""
    ranked = ~F.exists(dets, lambda d: d["area_rank"].isNull())
    return F.when((F.size(dets) > n) & ranked, F.slice(_ordered(dets, lambda d: d["area_rank"]), 1, n)).otherwise(dets)


def label_key(label: Column) -> Column:
    """Labels meet without case and outer blanks."""
    return F.lower(F.btrim(label, F.lit(" \t\n\r\x0b\x0c")))


def detection_for(dets: Column, label: Column, position: Column) -> Column:
    """The last detection with that label and position, else the nearest with that label, the first of equals; null if none."""
    same = F.filter(dets, lambda d: (label_key(d["label"]) == label_key(label)) & (label_key(label) != ""))
    at = F.filter(same, lambda d: F.nullif(F.btrim(d["position"]), F.lit("")) == position)
    return F.coalesce(F.try_element_at(at, F.lit(-1)), F.get(by_rank(same), F.lit(0)))


def ranked_places(dets: Column, key) -> Column:
    """The places in dets, from 0, in a stable order of the key; detections without a key come last."""
    keyed = F.transform(dets, lambda d, i: F.struct(key(d).isNull().alias("none"), key(d).alias("k"), i.alias("i")))
    return F.transform(F.sort_array(keyed), lambda x: x["i"])


def with_geometry(found: Column, width: Column, height: Column, *more: str) -> Column:
    """Detections (label, bbox, confidence, depth_value, mask_area) with position, ranks and free space added; more names fields that stay, last."""

    def one(d: Column, i: Column, all_: Column) -> Column:
        place = lambda order: F.array_position(order, i).cast("int")
        return F.struct(
            d["label"].alias("label"), d["bbox"].alias("bbox"), d["confidence"].alias("confidence"), d["depth_value"].alias("depth_value"),
            position(horizontal(d["bbox"], width), vertical(d["depth_value"])).alias("position"),
            F.when(d["depth_value"].isNull(), 0).otherwise(place(all_["deep"])).alias("depth_rank"), place(all_["wide"]).alias("area_rank"),
            free_space(d["label"], free_sides(d["bbox"], all_["edges"], width, height)).alias("free_space"), *[d[n].alias(n) for n in more],
        )

    # both orders and the edges belong to the image: inside the lambda each would be worked out for each detection
    deep, wide = ranked_places(found, lambda d: d["depth_value"]), ranked_places(found, lambda d: -d["mask_area"])
    return let(F.struct(deep.alias("deep"), wide.alias("wide"), edges(found).alias("edges")), lambda all_: F.transform(found, lambda d, i: one(d, i, all_)))


def _edges(box: Column) -> list[Column]:
    x1, y1, x2, y2 = (x_of(box, i) for i in range(4))
    return [x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), ((x1 + x2) / 2).alias("cx"), ((y1 + y2) / 2).alias("cy")]


def edges(dets: Column) -> Column:
    """For each detection its corners and middle."""
    return F.transform(dets, lambda d: F.struct(*_edges(d["bbox"])))


def free_sides(box: Column, others: Column, width: Column, height: Column) -> Column:
    """Sides whose edge keeps a quarter of the image clear and to which no aligned neighbour, of which others has the edges, comes closer than that."""

    def clear_of(b: Column) -> Column:
        level = lambda o: F.abs(o["cy"] - b["cy"]) < b["h"]
        plumb = lambda o: F.abs(o["cx"] - b["cx"]) < b["w"]
        sides = (
            ("left", b["x1"] > mx, lambda o: (o["cx"] < b["cx"]) & (o["x2"] > b["left"]) & level(o)),
            ("right", b["x2"] < width - mx, lambda o: (o["cx"] > b["cx"]) & (o["x1"] < b["right"]) & level(o)),
            ("above", b["y1"] > my, lambda o: (o["cy"] < b["cy"]) & (o["y2"] > b["above"]) & plumb(o)),
            ("below", b["y2"] < height - my, lambda o: (o["cy"] > b["cy"]) & (o["y1"] < b["below"]) & plumb(o)),
        )
        return F.array_compact(F.array(*[F.when(clear & ~F.exists(others, blocks), name) for name, clear, blocks in sides]))

    x1, y1, x2, y2 = (x_of(box, i) for i in range(4))
    mx, my = width * MARGIN, height * MARGIN
    near = [(x1 - mx).alias("left"), (x2 + mx).alias("right"), (y1 - my).alias("above"), (y2 + my).alias("below")]
    return let(F.struct(*_edges(box), (x2 - x1).alias("w"), (y2 - y1).alias("h"), *near), clear_of)


def free_space(label: Column, sides: Column) -> Column:
    """The clear sides in words; a box is never its own neighbour, as its middle is not beside itself."""
    # fixed values: both sentences
    clear = F.concat(F.lit("Clear space "), F.array_join(sides, ", "), F.lit(" of the "), label, F.lit("."))
    limited = F.concat(F.lit("Limited clear space immediately around the "), label, F.lit("."))
    return F.when(F.size(sides) > 0, clear).otherwise(limited)


def scene_text(dets: Column) -> Column:
    """A header and a numbered line for each detection in depth order, with its free space below it."""

    # fixed values: the header, the names in a line and the text for no objects
    def line(d: Column, i: Column) -> Column:
        return F.concat(
            (i + 1).cast("string"), F.lit(". "), d["label"], F.lit(" ["), d["position"], F.lit("] conf="), F.format_number(d["confidence"], 2),
            F.lit(" depth="), F.coalesce(F.format_number(d["depth_value"], 3), F.lit("n/a")), F.lit(" depth_rank="), d["depth_rank"].cast("string"),
            F.lit(" area_rank="), d["area_rank"].cast("string"), F.when(d["free_space"] != "", F.concat(F.lit("\n   "), d["free_space"])).otherwise(""),
        )

    def text(dets: Column) -> Column:
        head = F.concat(F.lit("SCENE GRAPH ("), F.size(dets).cast("string"), F.lit(" objects detected):"))
        return F.when(F.size(dets) == 0, "SCENE GRAPH: No objects detected.").otherwise(F.concat_ws("\n", head, F.array_join(F.transform(by_rank(dets), line), "\n")))

    return let(dets, text)
