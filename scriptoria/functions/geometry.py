"""Geometry on arrays of points, as Column expressions inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-9


def _x(p: Column) -> Column:
    return F.get(p, F.lit(0))


def _y(p: Column) -> Column:
    return F.get(p, F.lit(1))


def _corners(points: Column) -> list[tuple[Column, Column]]:
    """The first four points as plain doubles: most polygons are quadrilaterals, and expressions on these are compiled, which lambdas are not."""
    return [(_x(F.get(points, F.lit(i))).cast("double"), _y(F.get(points, F.lit(i))).cast("double")) for i in range(4)]


def _fine(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once: a lambda's variable is not put in again wherever it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def area(points: Column) -> Column:
    """Shoelace area of a polygon; 0 for fewer than three points."""
    n = F.size(points)
    (x0, y0), (x1, y1), (x2, y2), (x3, y3) = _corners(points)
    quad = F.abs(x0 * y1 - x1 * y0 + x1 * y2 - x2 * y1 + x2 * y3 - x3 * y2 + x3 * y0 - x0 * y3) / 2
    following = F.concat(F.slice(points, F.lit(2), F.greatest(n - 1, F.lit(0))), F.slice(points, F.lit(1), F.least(n, F.lit(1))))
    twice = F.aggregate(F.zip_with(points, following, lambda a, b: _x(a) * _y(b) - _x(b) * _y(a)), F.lit(0.0), lambda s, v: s + v.cast("double"))
    return F.when(n < 3, 0.0).when(n == 4, quad).otherwise(F.abs(twice) / 2)


def flat_area(flat: Column) -> Column:
    """The area of a triangle or quadrilateral [x, y, x, y, ...], in plain expressions."""
    v = [F.get(flat, F.lit(i)).cast("double") for i in range(8)]
    three = v[0] * v[3] - v[2] * v[1] + v[2] * v[5] - v[4] * v[3]
    return F.abs(F.when(F.size(flat) == 6, three + v[4] * v[1] - v[0] * v[5]).otherwise(three + v[4] * v[7] - v[6] * v[5] + v[6] * v[1] - v[0] * v[7])) / 2


def all_finite(numbers: Column, most: int) -> Column:
    """Whether an array of up to `most` numbers holds finite ones only, in plain expressions."""
    out = F.lit(True)
    for i in range(most):
        out = out & ((F.size(numbers) <= i) | _fine(F.get(numbers, F.lit(i))))
    return out


def flat_points(flat: Column) -> Column:
    """[x, y, x, y, ...] as points; null for fewer than three or an odd count."""
    n = F.size(flat)
    pairs = F.transform(F.sequence(F.lit(0), (n / 2).cast("int") - 1), lambda i: F.array(F.get(flat, i * 2), F.get(flat, i * 2 + 1)))
    return F.when((n >= 6) & (n % 2 == 0), pairs)


def turn(a: Column, b: Column, c: Column) -> Column:
    """Sign of the turn a-b-c: 0 where it is straight."""
    v = (_y(b) - _y(a)) * (_x(c) - _x(b)) - (_x(b) - _x(a)) * (_y(c) - _y(b))
    return F.when(F.abs(v) < EPSILON, 0).when(v > 0, 1).otherwise(-1)


def cross(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Whether segments a-b and c-d cross in a point inside both; touching ends and shared lines do not count."""
    return (turn(a, b, c) * turn(a, b, d) < 0) & (turn(c, d, a) * turn(c, d, b) < 0)


def self_crossing(points: Column) -> Column:
    """Whether opposite sides of a quadrilateral cross; false for other polygons."""
    p = [F.get(points, F.lit(i)) for i in range(4)]
    return (F.size(points) == 4) & (cross(p[0], p[1], p[2], p[3]) | cross(p[1], p[2], p[3], p[0]))


def clamp(points: Column, width: Column, height: Column) -> Column:
    """Points moved into the picture, as doubles."""
    hi = lambda n: F.greatest(n.cast("double") - 1, F.lit(0.0))
    into = lambda v, n: F.least(F.greatest(v.cast("double"), F.lit(0.0)), hi(n))
    return F.transform(points, lambda p: F.array(into(_x(p), width), into(_y(p), height)))


def snapped(points: Column, width: Column, height: Column) -> Column:
    """Points rounded half to even and moved into the picture, as whole numbers."""
    into = lambda v, n: F.least(F.greatest(F.bround(v.cast("double")), F.lit(0.0)), n.cast("double") - 1).cast("int")
    quad = F.array(*(F.array(into(x, width), into(y, height)) for x, y in _corners(points)))
    return F.when(F.size(points) == 4, quad).otherwise(F.transform(points, lambda p: F.array(into(_x(p), width), into(_y(p), height))))


def _pairs(points: Column) -> Column:
    """Whether every point has two numbers."""
    quad = F.lit(True)
    for i in range(4):
        quad = quad & (F.size(F.get(points, F.lit(i))) == 2)
    return F.coalesce(F.when(F.size(points) == 4, quad).otherwise(F.forall(points, lambda q: F.size(q) == 2)), F.lit(False))


def finite(points: Column) -> Column:
    """Whether every point is two finite numbers."""
    quad = F.lit(True)
    for i, (x, y) in enumerate(_corners(points)):
        quad = quad & (F.size(F.get(points, F.lit(i))) == 2) & _fine(x) & _fine(y)
    return F.coalesce(F.when(F.size(points) == 4, quad).otherwise(F.forall(points, lambda p: (F.size(p) == 2) & _fine(_x(p)) & _fine(_y(p)))), F.lit(False))


def _few_points(p: Column) -> Column:
    """Whether a polygon has fewer than three points that are not the same."""
    q = [F.get(p, F.lit(i)) for i in range(4)]
    known = lambda i: ~F.greatest(*([F.lit(False)] + [q[i] == q[j] for j in range(i)])) if i > 1 else q[1] != q[0]
    quad = 1 + sum((known(i).cast("int") for i in range(1, 4)), F.lit(0)) < 3
    return F.when(F.size(p) == 4, quad).otherwise(F.size(F.array_distinct(p)) < 3)


def polygon_problem(points: Column, p: Column, least_area: float) -> Column:
    """The first thing wrong with a detection polygon, null if it is good; `p` is what snapped() makes of it."""
    return (
        F.when(points.isNull() | (F.size(points) < 4), "points must contain at least four vertices")
        .when(~_pairs(points), "each point must be [x, y]")
        .when(~finite(points), "coordinates must be finite numbers")
        .when(_few_points(p), "polygon has fewer than three unique points")
        .when(self_crossing(p), "polygon is self-intersecting")
        .when(area(p) < least_area, F.format_string(f"polygon area %.3f is below {least_area}", area(p)))
    )


def bounds(points: Column) -> Column:
    """[left, top, right, bottom] of a polygon."""
    xs, ys = F.transform(points, _x), F.transform(points, _y)
    return F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def bounds_xywh(points: Column) -> Column:
    b = bounds(points)
    return F.array(b[0], b[1], b[2] - b[0], b[3] - b[1])


def crop_box(box: Column, width: Column, height: Column) -> Column:
    """Whole-pixel box around [x1, y1, x2, y2] within the picture, of one pixel at least."""
    side = {}
    for name, i, n in (("x", 0, width), ("y", 1, height)):
        lo, hi = F.least(box[i], box[i + 2]), F.greatest(box[i], box[i + 2])
        lo = F.greatest(F.lit(0), F.least(F.floor(lo).cast("int"), F.greatest(n - 1, F.lit(0))))
        hi = F.greatest(F.lit(0), F.least(F.ceil(hi).cast("int"), n))
        side[name] = lo, F.when(hi <= lo, F.least(n, lo + 1)).otherwise(hi)
    return F.array(side["x"][0], side["y"][0], side["x"][1], side["y"][1]).cast("array<int>")


def box_polygon(box: Column) -> Column:
    """The corners of [x1, y1, x2, y2], from the top left on."""
    x1, y1, x2, y2 = (F.get(box, F.lit(i)).cast("double") for i in range(4))
    return F.array(F.array(x1, y1), F.array(x2, y1), F.array(x2, y2), F.array(x1, y2))


def layout_polygon(numbers: Column) -> Column:
    """Four or eight numbers as a quadrilateral; null for anything else and for what is not finite."""
    eight = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.array(F.get(numbers, i * 2), F.get(numbers, i * 2 + 1)).cast("array<double>"))
    polygon = F.when(F.size(numbers) == 4, box_polygon(numbers)).when(F.size(numbers) == 8, eight)
    return F.when(finite(polygon), polygon)


def score(raw: Column) -> Column:
    """A number from 0 to 1, else null."""
    v = raw.try_cast("double")
    return F.when(~F.isnan(v) & v.between(0.0, 1.0), v)


def _resized(height: Column, width: Column, min_pixels: int, max_pixels: int, factor: int) -> tuple[Column, Column, Column]:
    """Sides of smart_resize(), which may still be 0, and whether the picture's sides allow any."""
    h0, w0 = height.cast("double"), width.cast("double")
    w1 = F.when(h0 < factor, F.bround(w0 * factor / h0)).otherwise(w0)
    h1 = F.greatest(h0, F.lit(float(factor)))
    h2 = F.when(w1 < factor, F.bround(h1 * factor / w1)).otherwise(h1)
    w2 = F.greatest(w1, F.lit(float(factor)))
    rh, rw = F.bround(h2 / factor) * factor, F.bround(w2 / factor) * factor
    down, up = F.sqrt(h2 * w2 / max_pixels), F.sqrt(F.lit(float(min_pixels)) / (h2 * w2))
    pick = lambda side, rounded: F.when(rh * rw > max_pixels, F.floor(side / down / factor) * factor).when(rh * rw < min_pixels, F.ceil(side * up / factor) * factor).otherwise(rounded).cast("int")
    return pick(h2, rh), pick(w2, rw), (h0 > 0) & (w0 > 0) & (F.greatest(h2, w2) / F.least(h2, w2) <= 200)


def smart_resize(height: Column, width: Column, min_pixels: int, max_pixels: int, factor: int = 28) -> Column:
    """struct(height, width) in multiples of `factor` whose product is within the limits; null where there is none.

    Sides below the factor are scaled up first; a side over 200 times the other has no such size.
    """
    h, w, fits = _resized(height, width, min_pixels, max_pixels, factor)
    return F.when(fits & (h > 0) & (w > 0), F.struct(h.alias("height"), w.alias("width")))


def visual_tokens(height: Column, width: Column, min_pixels: int = 50176, max_pixels: int = 451584, patch: int = 14, merge: int = 2) -> Column:
    """Tokens that a picture takes after smart_resize(); null where it has no size.

    The expression is long: give it a column of its own before others use it more than once.
    """
    h, w, fits = _resized(height, width, min_pixels, max_pixels, patch * merge)
    tokens = (F.floor(h / patch) * F.floor(w / patch) / merge**2).cast("int")
    return F.when(fits, F.nullif(tokens, F.lit(0)))  # no token: a side is 0


def text_tokens(prompt: Column, text: Column, tokenizer: object = None) -> Column:
    """Tokens of prompt and text and one end; code points unless `tokenizer` (Column -> Column) is given."""
    count = tokenizer or F.length
    return count(prompt) + count(text) + 1


# Views: what an editor does with a picture on a screen.


def fit_scale(width: Column, height: Column, view_width: Column, view_height: Column) -> Column:
    return F.least(view_width / width, view_height / height)


def to_screen(v: Column, scale: Column, offset: Column) -> Column:
    return v * scale + offset


def to_image(v: Column, scale: Column, offset: Column) -> Column:
    return (v - offset) / scale


def zoomed_offset(offset: Column, anchor: Column, scale: Column, new_scale: Column) -> Column:
    """The offset after a change of scale that leaves the anchor (on the screen) where it is."""
    return anchor - (anchor - offset) * new_scale / scale


def moved(points: Column, dx: Column, dy: Column, width: Column, height: Column) -> Column:
    """A polygon moved as a whole, as far as the picture allows."""
    b = bounds(points)
    ex = F.least(F.greatest(dx.cast("double"), -b[0]), F.greatest(width - 1, F.lit(0)) - b[2])
    ey = F.least(F.greatest(dy.cast("double"), -b[1]), F.greatest(height - 1, F.lit(0)) - b[3])
    return F.transform(points, lambda p: F.array(_x(p) + ex, _y(p) + ey))


def dragged_box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """The rectangle between two corners, in any order."""
    return box_polygon(F.array(F.least(x1, x2), F.least(y1, y2), F.greatest(x1, x2), F.greatest(y1, y2)))


# Least and greatest scale of a view; the inspector's sides in pixels, its shares and its zoom.
SCALES = (0.1, 8.0)
INSPECTOR_WIDTH, CANVAS_WIDTH, CROP_HEIGHT, EDITOR_HEIGHT = (340, 760), 420, 130, 180
SPLIT, ZOOM = (0.2, 0.72), (0.25, 4.0)


def between(v: Column, lo: Column | float, hi: Column | float) -> Column:
    """v, not below lo and not above hi (which wins where they are at odds)."""
    lo, hi = (x if isinstance(x, Column) else F.lit(x) for x in (lo, hi))
    return F.least(F.greatest(v, lo), hi)


def fit_view(view_width: Column, view_height: Column, width: Column, height: Column) -> Column:
    """struct(scale, x, y) of a view that shows the whole picture in the middle, not enlarged; without a side the plain view."""
    known = F.coalesce((view_width > 0) & (view_height > 0) & (width > 0) & (height > 0), F.lit(False))
    scale = F.when(known, F.least(fit_scale(width, height, view_width, view_height), F.lit(1.0))).otherwise(1.0)
    middle = lambda view, side: F.when(known, (view - side * scale) / 2).otherwise(0.0)
    return F.struct(scale.alias("scale"), middle(view_width, width).alias("x"), middle(view_height, height).alias("y"))


def zoomed_view(view: Column, x: Column, y: Column, wanted: Column) -> Column:
    """The view at the wanted scale, within limits, with the point (x, y) of the screen where it is."""
    scale = between(wanted.cast("double"), *SCALES)
    return F.struct(scale.alias("scale"), zoomed_offset(view["x"], x, view["scale"], scale).alias("x"), zoomed_offset(view["y"], y, view["scale"], scale).alias("y"))


def panned_view(view: Column, dx: Column, dy: Column) -> Column:
    return view.withField("x", view["x"] + dx).withField("y", view["y"] + dy)


def resized_edge(points: Column, edge: Column, x: Column, y: Column, width: Column, height: Column) -> Column:
    """A rectangle with one edge ('top', 'right', 'bottom', 'left') dragged to (x, y): inside the picture, and one pixel at least from the edge opposite."""
    (x0, y0), (x1, y1), (x2, y2), (x3, y3) = _corners(points)
    end_x, end_y = (F.greatest(n.cast("double") - 1, F.lit(0.0)) for n in (width, height))
    x, y = x.cast("double"), y.cast("double")
    top = between(y, 0.0, F.greatest(F.least(y2, y3) - 1, F.lit(0.0)))
    left = between(x, 0.0, F.greatest(F.least(x1, x2) - 1, F.lit(0.0)))
    right = F.least(F.greatest(F.least(x, end_x), F.least(end_x, F.greatest(x0, x3) + 1)), end_x)
    bottom = F.least(F.greatest(F.least(y, end_y), F.least(end_y, F.greatest(y0, y1) + 1)), end_y)
    top, left = F.least(top, end_y), F.least(left, end_x)
    pick = lambda name, new, old: F.when(edge == name, new).otherwise(old)
    return F.array(
        F.array(pick("left", left, x0), pick("top", top, y0)), F.array(pick("right", right, x1), pick("top", top, y1)),
        F.array(pick("right", right, x2), pick("bottom", bottom, y2)), F.array(pick("left", left, x3), pick("bottom", bottom, y3)),
    )


def crop_rect(points: Column, width: Column, height: Column) -> Column:
    """struct(left, top, right, bottom, width, height): the whole pixels around a polygon, at least one, inside the picture."""
    b = bounds(points)
    sides = {}
    for name, low, high, n in (("x", b[0], b[2], width), ("y", b[1], b[3], height)):
        n = F.greatest(n.cast("double"), F.lit(1.0))
        lo = between(F.floor(low).cast("double"), 0.0, n - 1)
        sides[name] = lo, between(F.ceil(high).cast("double"), lo + 1, n)
    (l, r), (t, e) = sides["x"], sides["y"]
    return F.struct(l.alias("left"), t.alias("top"), r.alias("right"), e.alias("bottom"), (r - l).alias("width"), (e - t).alias("height"))


def crop_view(box: Column, width: Column, height: Column, view_width: Column, view_height: Column, zoom: Column) -> Column:
    """How a crop (crop_rect()) is shown in a view: its scale (null zoom: fitted), the sides of content and canvas, and where both begin."""
    room = [F.greatest(v.cast("double"), F.lit(1.0)) for v in (view_width, view_height)]
    scale = F.when(zoom.isNull(), F.least(room[0] / box["width"], room[1] / box["height"])).otherwise(between(zoom.cast("double"), *ZOOM))
    content = [F.greatest(box[s] * scale, F.lit(1.0)) for s in ("width", "height")]
    canvas = [F.greatest(r, c) for r, c in zip(room, content, strict=True)]
    names = {
        "scale": scale, "content_width": content[0], "content_height": content[1], "canvas_width": canvas[0], "canvas_height": canvas[1],
        "clip_left": (canvas[0] - content[0]) / 2, "clip_top": (canvas[1] - content[1]) / 2, "image_left": -box["left"] * scale, "image_top": -box["top"] * scale,
        "image_width": F.greatest(width * scale, F.lit(1.0)), "image_height": F.greatest(height * scale, F.lit(1.0)),
    }
    return F.struct(*(c.alias(name) for name, c in names.items()))


def inspector_width(value: Column, view_width: Column, sidebar: int = 245, separator: int = 9) -> Column:
    """A pane's width between its limits, as far as the canvas beside it allows."""
    lo, hi = INSPECTOR_WIDTH
    most = F.greatest(F.lit(lo), F.least(F.lit(hi), view_width - sidebar - separator - CANVAS_WIDTH))
    return between(value, F.lit(lo), most)


def crop_height(total: Column, share: Column, separator: int = 9) -> Column:
    """The height of the crop's pane for its share of the whole, as far as the editor below allows."""
    most = F.greatest(F.lit(CROP_HEIGHT), F.greatest(total - separator, F.lit(0)) - EDITOR_HEIGHT)
    return between(total * between(share, *SPLIT), F.lit(float(CROP_HEIGHT)), most.cast("double"))


def crop_share(total: Column, height: Column, separator: int = 9) -> Column:
    """The share that a height of the crop's pane stands for."""
    most = F.greatest(F.lit(CROP_HEIGHT), F.greatest(total - separator, F.lit(0)) - EDITOR_HEIGHT)
    return between(between(height, F.lit(CROP_HEIGHT), most) / F.greatest(total, F.lit(1)), *SPLIT)
