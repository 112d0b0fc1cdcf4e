"""N-dimensional statistics cubes (JSON-stat style) <-> flat rows.

A cube is ``{"id": [dim...], "size": [n...], "dimension": {dim: {"category":
{"index": {member: i}, "label": {member: text}}}}, "value": [v...]}`` with
``value`` in row-major order over the dimensions.  Flattening never builds
the cartesian product of the label lists: each value's position is
decomposed into per-dimension coordinates with integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATEGORY = T.StructType([T.StructField("category", T.StructType([
    T.StructField("index", T.MapType(T.StringType(), T.LongType())),
    T.StructField("label", T.MapType(T.StringType(), T.StringType()))]))])
CUBE_SCHEMA = T.StructType([
    T.StructField("id", T.ArrayType(T.StringType())),
    T.StructField("size", T.ArrayType(T.LongType())),
    T.StructField("dimension", T.MapType(T.StringType(), CATEGORY)),
    T.StructField("value", T.ArrayType(T.DoubleType())),
])

#: Cells of a piece of a large cube.
PIECE = 500_000


def _members(cube: Column, dim: str) -> Column:
    """Members of ``dim`` in index order; label-object order when no index is given."""
    cat = cube["dimension"][dim]["category"]
    by_index = F.transform(
        F.array_sort(F.map_entries(cat["index"]),
                     lambda a, b: F.when(a["value"] < b["value"], -1)
                     .when(a["value"] > b["value"], 1).otherwise(0)),
        lambda e: e["key"])
    return F.coalesce(by_index, F.map_keys(cat["label"]))


def flatten_cube(df: DataFrame, dims: list[str], col: str = "json", value_name: str = "value",
                 int_dims: tuple[str, ...] = (), keep_nulls: bool = False,
                 partitions: int | None = None) -> DataFrame:
    """One row per non-null cell: (dim_1 label, ..., dim_n label, value as int).

    ``dims`` names the dimensions to output (their positions are looked up
    in each cube's ``id`` list, so cubes may order them differently).  A
    large cube is one task for the explode; ``partitions`` spreads the
    exploded cells before further work.
    """
    cubes = df.select(F.from_json(F.col(col), CUBE_SCHEMA).alias("_cube"))
    return flatten_cubes(cubes, dims, value_name, int_dims, keep_nulls, partitions)


def read_cubes(spark, path: str, multi_line: bool = False) -> DataFrame:
    """Scan cube JSON files with the explicit cube schema (column ``_cube``).
    ``multi_line`` for one pretty-printed cube per file, else one cube per line."""
    raw = spark.read.schema(CUBE_SCHEMA).option("multiLine", multi_line).json(path)
    return raw.select(F.struct(*raw.columns).alias("_cube"))


def flatten_cubes(cubes: DataFrame, dims: list[str], value_name: str = "value",
                  int_dims: tuple[str, ...] = (), keep_nulls: bool = False,
                  partitions: int | None = None) -> DataFrame:
    """Flatten parsed cubes held in a struct column ``_cube`` (see :func:`flatten_cube`).

    Per-dimension member lists, sizes and strides are computed once per cube
    (not once per cell); each exploded cell then needs only a division, a
    modulo and an array lookup per dimension.
    """
    pre = _with_lists(cubes, dims)
    cells = pre.select("*", F.posexplode("_values").alias("_pos", "_v")).drop("_values")
    if not keep_nulls:
        cells = cells.filter(F.col("_v").isNotNull())
    if partitions:
        cells = cells.repartition(partitions)
    return _labelled(cells, dims, value_name, int_dims)


def flatten_cubes_in_pieces(cubes: DataFrame, dims: list[str], value_name: str = "value",
                            int_dims: tuple[str, ...] = (), keep_nulls: bool = False,
                            piece: int = PIECE) -> DataFrame:
    """:func:`flatten_cubes` for cubes of more cells than one task should make, same rows.

    A cube's value array is cut into pieces of ``piece`` cells, each with its
    offset and its cube's member lists, and the pieces are dealt out by size
    before any cell is made.  Only reading the cube's text is left to one task.
    """
    pre = _with_lists(cubes, dims)
    n = F.size("_values")
    offsets = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(piece)))
    lists = [c for c in pre.columns if c != "_values"]
    pieces = (pre.select("*", F.explode(offsets).alias("_offset"))
              .select(*lists, "_offset", F.slice("_values", F.col("_offset") + 1, F.lit(piece)).alias("_part"))
              .hint("rebalance"))
    cells = pieces.select("*", F.posexplode("_part").alias("_at", "_v")).withColumn(
        "_pos", F.col("_offset") + F.col("_at")).drop("_part", "_offset", "_at")
    return _labelled(cells if keep_nulls else cells.filter(F.col("_v").isNotNull()), dims, value_name, int_dims)


def _with_lists(cubes: DataFrame, dims: list[str]) -> DataFrame:
    """Per cube: size, stride, members and labels of every dimension, and the values."""
    cube = F.col("_cube")
    n = F.size(cube["id"])
    sizes = F.coalesce(cube["size"], F.transform(
        cube["id"], lambda d: F.size(_members(cube, d)).cast("long")))
    per_cube = []
    for i, dim in enumerate(dims):
        k = F.array_position(cube["id"], F.lit(dim)).cast("int")           # 1-based
        per_cube += [
            F.element_at(sizes, k).alias(f"_n{i}"),
            F.aggregate(F.slice(sizes, k + 1, n - k), F.lit(1).cast("long"),
                        lambda acc, x: acc * x).alias(f"_st{i}"),
            _members(cube, dim).alias(f"_m{i}"),
            cube["dimension"][dim]["category"]["label"].alias(f"_l{i}"),
        ]
    return cubes.select(*per_cube, cube["value"].alias("_values"))


def _labelled(cells: DataFrame, dims: list[str], value_name: str, int_dims: tuple[str, ...]) -> DataFrame:
    """Positions to labels by integer arithmetic, values to whole numbers."""
    out = []
    for i, dim in enumerate(dims):
        coord = F.pmod(F.floor(F.col("_pos") / F.col(f"_st{i}")).cast("long"), F.col(f"_n{i}"))
        member = F.element_at(F.col(f"_m{i}"), (coord + 1).cast("int"))
        label = F.coalesce(F.element_at(F.col(f"_l{i}"), member), member)
        out.append((label.cast("int") if dim in int_dims else label).alias(dim))
    out.append(F.col("_v").cast("long").alias(value_name))
    return cells.select(*out)


def build_cubes(df: DataFrame, cube_key: str, dims: list[str], value: str) -> DataFrame:
    """Render a fact as one cube per ``cube_key`` value (column ``json``).

    Members per dimension are the sorted distinct values within the cube;
    missing combinations become NULL cells.  Each cube collects at most the
    product of its dimension sizes, which is bounded by the domain (years x
    bands x ...), not by the number of fact rows.
    """
    members = df.groupBy(cube_key).agg(
        *[F.array_sort(F.collect_set(F.col(d).cast("string"))).alias(f"_m_{d}") for d in dims])
    j = df.join(members, cube_key)
    idx = [(F.array_position(F.col(f"_m_{d}"), F.col(d).cast("string")) - 1).cast("long")
           for d in dims]
    sizes = [F.size(F.col(f"_m_{d}")).cast("long") for d in dims]
    pos = idx[0]
    for i, s in zip(idx[1:], sizes[1:]):
        pos = pos * s + i
    cells = j.select(cube_key, *[F.col(f"_m_{d}") for d in dims], pos.alias("_pos"),
                     F.col(value).cast("double").alias("_v"))
    per = cells.groupBy(cube_key, *[f"_m_{d}" for d in dims]).agg(
        F.map_from_entries(F.collect_list(F.struct("_pos", "_v"))).alias("_cells"))
    total = sizes[0]
    for s in sizes[1:]:
        total = total * s
    values = F.transform(F.sequence(F.lit(0).cast("long"), total - 1),
                         lambda i: F.try_element_at(F.col("_cells"), i))
    dim_struct = F.struct(*[F.struct(F.struct(
        F.map_from_arrays(F.col(f"_m_{d}"), F.sequence(F.lit(0).cast("long"), s - 1)).alias("index"),
        F.map_from_arrays(F.col(f"_m_{d}"), F.col(f"_m_{d}")).alias("label")).alias("category")).alias(d)
        for d, s in zip(dims, sizes)])
    rec = F.struct(F.array(*[F.lit(d) for d in dims]).alias("id"), F.array(*sizes).alias("size"),
                   dim_struct.alias("dimension"), values.alias("value"))
    return per.select(cube_key, F.to_json(rec).alias("json"))


def cube_shape_issues(df: DataFrame, col: str = "json") -> DataFrame:
    """Cubes whose value count differs from the product of their dimension sizes
    (the original only warned, then failed on too few values).  Returns
    (row of the input, expected_cells, actual_cells) for each bad cube."""
    cube = F.from_json(F.col(col), CUBE_SCHEMA)
    sizes = F.coalesce(cube["size"], F.transform(cube["id"], lambda d: F.size(_members(cube, d)).cast("long")))
    expected = F.aggregate(sizes, F.lit(1).cast("long"), lambda acc, x: acc * x)
    out = df.select("*", expected.alias("expected_cells"), F.size(cube["value"]).cast("long").alias("actual_cells"))
    return out.filter(F.col("expected_cells") != F.col("actual_cells"))
