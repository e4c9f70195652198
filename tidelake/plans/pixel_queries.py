"""Pixel jobs over pictures derived from the embeddings table.

Each vector is an 8 x 8 grey picture; three vectors in a row are the R, G and B planes of a colour
picture; sixteen make a 32 x 32 grey picture. The SQL works in long form, one row per pixel.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidelake.operators import images
from tidelake.operators.ledger import pair_masks
from tidelake.plans.catalogue import query, table
from tidelake.schema import as_image

LEVELS = """transform(embedding,
    v -> cast(least(255, greatest(0, floor((cast(v as double) + 0.5D) * 255))) as int))"""


def _black() -> Column:
    """A plane that the last picture lacks."""
    return F.expr("array_repeat(0, 64)")


def _bytes(levels: Column) -> Column:
    return F.unhex(F.array_join(F.transform(levels, lambda p: F.lpad(F.hex(p), 2, "0")), ""))


def grey8(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("image_id"), F.expr(LEVELS).alias("levels")
    )
    side = F.lit(8)
    return rows.select(
        "image_id",
        F.md5(F.col("image_id").cast("string")).alias("content_hash"),
        as_image(_bytes(F.col("levels")), side, side, F.lit(1)).alias("image"),
    )


def rgb8(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.expr(LEVELS).alias("levels"))
    plane = F.col("vec_id") % 3
    planes = (
        rows.groupBy(F.floor(F.col("vec_id") / 3).alias("image_id"))
        .agg(*[F.coalesce(F.max(F.when(plane == i, F.col("levels"))), _black()).alias(n) for i, n in enumerate("rgb")])
    )
    interleaved = F.flatten(
        F.transform(F.arrays_zip("b", "g", "r"), lambda p: F.array(p["b"], p["g"], p["r"]))
    )
    side = F.lit(8)
    return planes.select(
        "image_id",
        F.md5(F.col("image_id").cast("string")).alias("content_hash"),
        as_image(_bytes(interleaved), side, side, F.lit(3)).alias("image"),
    )


def grey32(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.expr(LEVELS).alias("levels"))
    # sixteen rows per group by construction
    parts = rows.groupBy(F.floor(F.col("vec_id") / 16).alias("image_id")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("vec_id") % 16, "levels"))).alias("parts")
    )
    by_place = F.map_from_entries("parts")
    places = F.sequence(F.lit(0).cast("long"), F.lit(15).cast("long"))
    levels = F.flatten(F.transform(places, lambda i: F.coalesce(F.try_element_at(by_place, i), _black())))
    side = F.lit(32)
    return parts.select(
        "image_id",
        F.md5(F.col("image_id").cast("string")).alias("content_hash"),
        as_image(_bytes(levels), side, side, F.lit(1)).alias("image"),
    )


def pixels(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "image_id",
        *more,
        F.col("image.width").alias("width"),
        F.col("image.height").alias("height"),
        F.hex("image.data").alias("pixels"),
    )


GREY = """
    px as (select vec_id as image_id, (i - 1) % 8 as x, (i - 1) // 8 as y, 0 as c,
                  cast(least(255, greatest(0, floor((cast(embedding[i] as double) + 0.5) * 255)))
                       as integer) as v
           from embeddings, range(1, 65) t(i))
"""
RGB = GREY + """,
    rgb as (select g.image_id, t.x, t.y, t.c, coalesce(px.v, 0) as v
            from (select distinct image_id // 3 as image_id from px) g,
                 (select i % 8 as x, i // 8 % 8 as y, i // 64 as c from range(192) r(i)) t
            left join px on px.image_id = g.image_id * 3 + t.c and px.x = t.x and px.y = t.y)
"""
GREY32 = GREY + """,
    big as (select g.image_id, t.i % 32 as x, t.i // 32 as y, 0 as c, coalesce(px.v, 0) as v
            from (select distinct image_id // 16 as image_id from px) g, (select i from range(1024) r(i)) t
            left join px on px.image_id = g.image_id * 16 + t.i // 64 and px.y = t.i % 64 // 8 and px.x = t.i % 8)
"""
SHOW = """
    select image_id, cast(max(x) + 1 as integer) as width, cast(max(y) + 1 as integer) as height,
           string_agg(printf('%02X', v), '' order by y, x, c desc) as pixels
    from res group by image_id
"""


def _draw(step: str) -> str:
    return (
        f"(cast('0x' || substr(md5(md5(cast(image_id as varchar)) || '|0|{step}'), 1, 12) as bigint)"
        " / cast(281474976710656 as double))"
    )


def _long(prefix: str, body: str) -> str:
    return f"with {prefix}, {body} {SHOW}"


@query(
    _long(
        GREY,
        f"res as (select image_id, case when {_draw('mirror')} < 0.5 then 7 - x else x end as x, y, c, v from px)",
    )
)
def px_mirror(spark, sf_dir):
    return pixels(images.standardise_images(grey8(spark, sf_dir), [images.mirror(0.5)]))


@query(
    _long(
        GREY,
        f"""f as (select image_id, cast(case when {_draw('brightness.p')} < 0.5
                 then 0.8::double + (1.2::double - 0.8::double) * {_draw('brightness.factor')} else 1 end as float) as k
                 from (select distinct image_id from px)),
        res as (select image_id, x, y, c,
                cast(least(255, trunc(cast(v as float) * k)) as integer) as v from px join f using (image_id))""",
    )
)
def px_brightness(spark, sf_dir):
    return pixels(images.standardise_images(grey8(spark, sf_dir), [images.brightness(0.8, 1.2, 0.5)]))


@query(
    _long(
        RGB,
        """s as (select image_id, c, list_sort(list(v)) as l from rgb group by all),
        b as (select image_id, c, l[2] as lo, l[63] as hi from s),
        res as (select image_id, x, y, c, case when hi <= lo then v else
            cast(trunc(greatest(0, least(255, v * (255.0::double / (hi - lo)) + -lo * (255.0::double / (hi - lo)))))
                 as integer) end as v
            from rgb join b using (image_id, c))""",
    )
)
def px_autocontrast(spark, sf_dir):
    return pixels(images.standardise_images(rgb8(spark, sf_dir), [images.autocontrast(2)]))


@query(
    _long(
        RGB,
        """res as (select a.image_id, a.x, a.y, a.c, list_sort(list(b.v))[5] as v
            from rgb a, range(-1, 2) dx(i), range(-1, 2) dy(j), rgb b
            where b.image_id = a.image_id and b.c = a.c
              and b.x = greatest(0, least(7, a.x + dx.i)) and b.y = greatest(0, least(7, a.y + dy.j))
            group by all)""",
    )
)
def px_median(spark, sf_dir):
    return pixels(images.standardise_images(rgb8(spark, sf_dir), [images.median()]))


@query(
    _long(
        GREY32,
        """h as (select image_id, v, count(*) as n from big group by all),
        t as (select image_id, v, n, sum(n) over (partition by image_id order by v) - n as below,
                     (1024 - last_value(n) over (partition by image_id order by v
                      rows between unbounded preceding and unbounded following)) // 255 as step from h),
        res as (select image_id, x, y, c, cast(case when step = 0 then v
                    else least(255, (step // 2 + below) // step) end as integer) as v
                from big join t using (image_id, v))""",
    )
)
def px_equalize(spark, sf_dir):
    return pixels(images.standardise_images(grey32(spark, sf_dir), [images.equalize()]))


@query(
    _long(
        RGB,
        """m as (select image_id, c, avg(v) as m from rgb group by all),
        t as (select image_id, (max(m) filter (where c = 0) + max(m) filter (where c = 1)
                                + max(m) filter (where c = 2)) / 3 as t from m group by image_id),
        res as (select image_id, x, y, c, cast(trunc(least(255,
                    v * (case when m > 0 then t / m else 1 end))) as integer) as v
                from rgb join m using (image_id, c) join t using (image_id))""",
    )
)
def px_white_balance(spark, sf_dir):
    return pixels(images.standardise_images(rgb8(spark, sf_dir), [images.white_balance()]))


@query(
    _long(
        RGB,
        """g as (select image_id, x, y, sum(v * case c when 0 then 19595 when 1 then 38470 else 7471 end) as s
              from rgb group by all),
        l as (select image_id, x, y, cast((s + 32768) >> 16 as integer) as g from g),
        res as (select image_id, x, y, c, cast(trunc(greatest(0, least(255,
                    cast(g as float) + cast(1.1 as float) * cast(v - g as float)))) as integer) as v
                from rgb join l using (image_id, x, y))""",
    )
)
def px_saturation(spark, sf_dir):
    return pixels(images.standardise_images(rgb8(spark, sf_dir), [images.saturation(1.1)]))


@query(_long(GREY, "res as (select image_id, x, y, k.c, v from px, range(0, 3) k(c))"))
def px_to_rgb(spark, sf_dir):
    return pixels(images.standardise_images(grey8(spark, sf_dir), [images.to_rgb()]))


@query(
    _long(
        RGB,
        """res as (select image_id, x, y, c, cast(trunc(greatest(0, least(255,
            ((cast(cast(v as float) / cast(255 as float) as double) - m) / s * s + m) * 255))) as integer) as v
            from rgb join (values (0, 0.485::double, 0.229::double), (1, 0.456::double, 0.224::double),
                                  (2, 0.406::double, 0.225::double)) k(c, m, s) using (c))""",
    )
)
def px_colour_norm(spark, sf_dir):
    return pixels(images.standardise_images(rgb8(spark, sf_dir), [images.colour_norm()]))


def _weights(radius: int, kernel: str, sides: str) -> str:
    """Weights of input pixel ``i`` for output pixel ``o`` when 8 pixels become ``side``."""
    return f"""
        wr as (select s.side, o.o, i.i, (i.i + 0.5 - (o.o + 0.5) * 8.0::double / s.side)
                      / greatest(8.0::double / s.side, 1) as d,
                      cast(floor(greatest((o.o + 0.5) * 8.0::double / s.side
                          - {radius} * greatest(8.0::double / s.side, 1) + 0.5, 0)) as integer) as a,
                      cast(floor(least((o.o + 0.5) * 8.0::double / s.side
                          + {radius} * greatest(8.0::double / s.side, 1) + 0.5, 8)) as integer) as b
               from (select unnest([{sides}]) as side) s, range(0, 64) o(o), range(0, 8) i(i) where o.o < s.side),
        wk as (select side, o, i, {kernel} as k from wr where i >= a and i < b),
        w as (select side, o, i, k / sum(k) over (partition by side, o) as w from wk)
    """


LANCZOS = """case when abs(d) >= 3 then 0 when d = 0 then 1
    else sin(pi() * d) / (pi() * d) * sin(pi() * d / 3) / (pi() * d / 3) end"""
TRIANGLE = "greatest(1 - abs(d), 0)"


def _resized(source: str, side: str) -> str:
    """8 x 8 pictures resized, first along x and then along y, rounded after each."""
    return f"""
        hp as (select p.image_id, p.y, p.c, s.side, w.o as x,
                      cast(floor(greatest(0, least(255, floor(sum(p.v * w.w) + 0.5 + 1e-9::double)))) as integer) as v
               from {source} p join {side} s using (image_id) join w on w.side = s.side and w.i = p.x
               group by all),
        vp as (select p.image_id, p.x, p.c, p.side, w.o as y,
                      cast(floor(greatest(0, least(255, floor(sum(p.v * w.w) + 0.5 + 1e-9::double)))) as integer) as v
               from hp p join w on w.side = p.side and w.i = p.y group by all)
    """


@query(
    _long(
        RGB,
        _weights(3, LANCZOS, "6")
        + ", sd as (select distinct image_id, 6 as side from rgb),"
        + _resized("rgb", "sd")
        + ", res as (select * from vp)",
    )
)
def px_crop_center(spark, sf_dir):
    return pixels(images.standardise_images(rgb8(spark, sf_dir), [images.crop("center", 6)]))


@query(
    _long(
        RGB,
        _weights(3, LANCZOS, "20, 21, 22, 23, 24, 25")
        + f""", sd as (select image_id, cast(trunc(20 / (0.8::double + 0.2::double * u)) as integer) as side,
                    cast(trunc(l * (trunc(20 / (0.8::double + 0.2::double * u)) - 19)) as integer) as le,
                    cast(trunc(t * (trunc(20 / (0.8::double + 0.2::double * u)) - 19)) as integer) as tp
             from (select image_id, {_draw('crop.scale')} as u, {_draw('crop.left')} as l,
                          {_draw('crop.top')} as t from (select distinct image_id from rgb))),"""
        + _resized("rgb", "sd")
        + """, res as (select image_id, x - le as x, y - tp as y, c, v from vp join sd using (image_id)
                where x >= le and x < le + 20 and y >= tp and y < tp + 20)""",
    )
)
def px_crop_random(spark, sf_dir):
    return pixels(images.standardise_images(rgb8(spark, sf_dir), [images.crop("random", 20)]))


@query(
    _long(
        GREY,
        _weights(1, TRIANGLE, "12")
        + ", sd as (select distinct image_id, 12 as side from px),"
        + _resized("px", "sd")
        + ", res as (select * from vp)",
    )
)
def px_resize_bilinear(spark, sf_dir):
    return pixels(images.standardise_images(grey8(spark, sf_dir), [images.resize(12, 12, "bilinear")]))


@query(
    _long(
        GREY,
        """o as (select b.i as y, a.i as x, cast(trunc((b.i + 0.5) * 8.0::double / 5) as integer) as sy,
                     cast(trunc((a.i + 0.5) * 8.0::double / 11) as integer) as sx
              from range(0, 11) a(i), range(0, 5) b(i)),
        res as (select image_id, o.x, o.y, c, v from px join o on px.x = o.sx and px.y = o.sy)""",
    )
)
def px_resize_nearest(spark, sf_dir):
    return pixels(images.standardise_images(grey8(spark, sf_dir), [images.resize(5, 11, "nearest")]))


@query(
    _long(
        RGB,
        f"""a as (select image_id, radians((2 * {_draw('rotate')} - 1) * 10) as t from (select distinct image_id from rgb)),
        g as (select image_id, i.i as x, j.i as y,
                     cos(t) * (i.i + 0.5 - 4) - sin(t) * (j.i + 0.5 - 4) + 4 as fx,
                     sin(t) * (i.i + 0.5 - 4) + cos(t) * (j.i + 0.5 - 4) + 4 as fy
              from a, range(0, 8) i(i), range(0, 8) j(i)),
        n as (select *, fx - 0.5 - floor(fx - 0.5) as dx, fy - 0.5 - floor(fy - 0.5) as dy,
                     fx >= 0 and fx < 8 and fy >= 0 and fy < 8 as inside,
                     greatest(0, least(7, cast(floor(fx - 0.5) as integer))) as x0,
                     greatest(0, least(7, cast(floor(fx - 0.5) as integer) + 1)) as x1,
                     greatest(0, least(7, cast(floor(fy - 0.5) as integer))) as y0,
                     greatest(0, least(7, cast(floor(fy - 0.5) as integer) + 1)) as y1 from g),
        res as (select n.image_id, n.x, n.y, p.c, case when inside then cast(trunc(
                    (p.v + (q.v - p.v) * dx) + ((r.v + (s.v - r.v) * dx) - (p.v + (q.v - p.v) * dx)) * dy)
                    as integer) else 0 end as v
                from n join rgb p on p.image_id = n.image_id and p.x = n.x0 and p.y = n.y0
                join rgb q on q.image_id = n.image_id and q.x = n.x1 and q.y = n.y0 and q.c = p.c
                join rgb r on r.image_id = n.image_id and r.x = n.x0 and r.y = n.y1 and r.c = p.c
                join rgb s on s.image_id = n.image_id and s.x = n.x1 and s.y = n.y1 and s.c = p.c)""",
    )
)
def px_rotate(spark, sf_dir):
    return pixels(images.standardise_images(rgb8(spark, sf_dir), [images.rotate(10)]))


@query(
    f"""with {RGB}, n as (select image_id, c, y, x,
            (cast(v as float) / cast(255 as float) - m) / s as e
            from rgb join (values (0, 0.485::float, 0.229::float), (1, 0.456::float, 0.224::float),
                                  (2, 0.406::float, 0.225::float)) k(c, m, s) using (c))
        select image_id, count(*) as n, round(sum(round(cast(e as double), 4)), 4) as total,
               round(cast(max(e) filter (where c = 0 and x = 3 and y = 5) as double), 3) as sample
        from n group by image_id"""
)
def px_model_input(spark, sf_dir):
    from tidelake.functions.kernels import IMAGENET_MEAN, IMAGENET_STD

    vectors = images.image_vectors(rgb8(spark, sf_dir), IMAGENET_MEAN, IMAGENET_STD)
    rounded = F.transform("vector", lambda v: F.round(v.cast("double"), 4))
    return vectors.select(
        "image_id",
        F.size("vector").cast("long").alias("n"),
        F.round(F.aggregate(rounded, F.lit(0.0), lambda a, b: a + b), 4).alias("total"),
        F.round(F.col("vector")[43].cast("double"), 3).alias("sample"),
    )


def toy_model():
    """Class c of 0 .. 10 scores -(p - 25 c)^2 for grey level p: whole numbers, easy to check."""

    def scores(batch):
        level = np.rint(batch[:, :1] * 255)
        return -((level - 25 * np.arange(11).reshape(1, 11, 1, 1)) ** 2)

    return scores


MASK = """
    sc as (select image_id, x, y, k.k, -(v - 25 * k.k) * (v - 25 * k.k) as score
           from {source} p, range(0, 11) k(k) where p.c = 0),
    mask as (select image_id, x, y, cast(arg_max(k, score * 100 - k) as integer) as m from sc group by all)
"""


@query(
    f"""with {GREY}, {MASK.format(source='px')}, res as (select image_id, x, y, 0 as c, m as v from mask),
        shown as ({SHOW}) select image_id, pixels as classes, mx as largest_class
        from shown join (select image_id, max(m) as mx from mask group by image_id) using (image_id)"""
)
def label_argmax(spark, sf_dir):
    labelled = images.label_images(grey8(spark, sf_dir), toy_model, batch=8, size=None)
    mask = F.hex("mask.data")
    largest = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.substring(mask, i * 2 + 1, 2)))
    return labelled.filter("error is null").select(
        "image_id", mask.alias("classes"), F.conv(largest, 16, 10).cast("int").alias("largest_class")
    )


def _jet(points: list[tuple[float, float]]) -> str:
    cases = [
        f"when p / 255.0::double <= {b[0]}::double then {(b[1] - a[1])}::double / ({b[0]}::double - {a[0]}::double)"
        f" * (p * (1.0::double / 255) - {a[0]}::double) + {a[1]}::double"
        for a, b in zip(points, points[1:])
    ]
    return f"case {' '.join(cases)} end"


RED = [(0, 0), (0.35, 0), (0.66, 1), (0.89, 1), (1, 0.5)]
GREEN = [(0, 0), (0.125, 0), (0.375, 1), (0.64, 1), (0.91, 0), (1, 0)]
BLUE = [(0, 0.5), (0.11, 1), (0.34, 1), (0.65, 0), (1, 0)]


@query(
    _long(
        RGB,
        MASK.format(source="rgb")
        + f""", big as (select image_id, greatest(max(m), 1) as mx from mask group by image_id),
        pl as (select image_id, x, y, cast(least(255, trunc(m / cast(mx as double) * 256)) as integer) as p
               from mask join big using (image_id)),
        col as (select image_id, x, y, {_jet(RED)} as r, {_jet(GREEN)} as g, {_jet(BLUE)} as b from pl),
        res as (select image_id, x, y, c, cast(trunc(least(255, (1 - 0.4::double) * v + 0.4::double
                    * trunc(255 * case c when 0 then r when 1 then g else b end))) as integer) as v
                from rgb join col using (image_id, x, y))""",
    )
)
def overlay(spark, sf_dir):
    labelled = images.label_images(rgb8(spark, sf_dir), toy_model, batch=16, size=None)
    return pixels(images.overlay_masks(labelled.drop("error"), 0.4))


@query(
    f"""with {GREY}, {MASK.format(source='px')}
        select 'vec' || (image_id // 100) as source_file, image_id as row_index, cast(sum(m) as bigint) as mask_sum
        from mask group by all"""
)
def pair_masks_apart(spark, sf_dir):
    """Images and masks stored apart and paired by provenance."""
    place = [
        F.concat(F.lit("vec"), F.floor(F.col("image_id") / 100).cast("string")).alias("source_file"),
        F.col("image_id").alias("row_index"),
    ]
    pictures = grey8(spark, sf_dir)
    masks = images.label_images(pictures, toy_model, size=None)
    paired = pair_masks(pictures.select(*place, "content_hash"), masks.select(*place, "mask"))
    mask = F.hex("mask.data")
    classes = F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda i: F.conv(F.substring(mask, i * 2 + 1, 2), 16, 10).cast("long")
    )
    return paired.select(
        "source_file",
        "row_index",
        F.aggregate(classes, F.lit(0).cast("long"), lambda a, b: a + b).alias("mask_sum"),
    )


@query(
    f"""with {RGB} select image_id, round(avg(v) filter (where c = 0), 6) as mean_r,
        round(avg(v) filter (where c = 1), 6) as mean_g, round(avg(v) filter (where c = 2), 6) as mean_b
        from rgb group by image_id"""
)
def channel_means(spark, sf_dir):
    vectors = images.image_vectors(rgb8(spark, sf_dir))

    def mean(first: int) -> Column:
        part = F.slice("vector", first, 64)
        levels = F.transform(part, lambda v: F.round(v * 255).cast("double"))
        return F.round(F.aggregate(levels, F.lit(0.0), lambda a, b: a + b) / 64, 6)

    return vectors.select(
        "image_id", mean(1).alias("mean_r"), mean(65).alias("mean_g"), mean(129).alias("mean_b")
    )


@query(
    f"""with {RGB}, l as (select image_id, x, y, (sum(v * case c when 0 then 19595 when 1 then 38470 else 7471 end)
            + 32768) // 65536 as g from rgb group by all)
        select image_id, cast(y as integer) as row, round(avg(g), 6) as level from l group by all"""
)
def px_grey_luma(spark, sf_dir):
    """Mean grey level of each picture row."""
    profiles = images.row_profile(rgb8(spark, sf_dir))
    rows = profiles.select("image_id", F.posexplode("profile").alias("row", "level"))
    return rows.withColumn("level", F.round("level", 6))


@query()
def standardise(spark, sf_dir):
    """The whole default chain at the default size."""
    # the fixture's rows are tiny, the work per row is not: cut by rows, not by bytes
    tasks = 4 * spark.sparkContext.defaultParallelism
    pictures = rgb8(spark, sf_dir).repartition(tasks, "image_id")
    ready = images.standardise_images(pictures, images.default_steps(256), seed=7)
    return pixels(ready, "error").withColumn("pixels", F.md5("pixels"))
