"""Category trees: flattening, ancestor chains, counts and orders.

Nodes without id have no path; repeated nodes have repeated paths; a parent that isn't there, or is null, makes a root; no nodes: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumry.session import set_checkpoint_dir

#: Levels after which the plan of a deep tree is cut.
LEVELS_A_PLAN = 8


def paths(nodes: DataFrame, separator: str = "/") -> DataFrame:
    """nodes (id, parent_id, slug) -> (id, level, path): the chain from the root, joined.

    Levels are joined one after another until none is new, however deep the tree is;
    a parent that isn't there makes a root. Nodes on or below a cycle have no root: a ValueError.
    """
    total = nodes.count()
    set_checkpoint_dir(nodes.sparkSession)
    known = nodes.select(F.col("id").alias("parent_id"))
    roots = nodes.join(known, "parent_id", "left_anti").select("id", F.lit(1).alias("level"), F.col("slug").alias("path"))
    out, level = roots, roots
    k = 1
    while True:
        k += 1
        up = level.select(F.col("id").alias("parent_id"), F.col("path").alias("_up"))
        level = nodes.join(up, "parent_id").select("id", F.lit(k).alias("level"), F.concat_ws(separator, "_up", "slug").alias("path"))
        if level.isEmpty():
            break
        if k > total:
            raise ValueError("repeated ids make a cycle in the tree")
        if k % LEVELS_A_PLAN == 0:
            level = level.checkpoint()
        out = out.unionByName(level)
    if not nodes.where("id IS NOT NULL").join(out.select("id"), "id", "left_anti").isEmpty():
        raise ValueError("there are nodes on or below a cycle")
    return out


def own_counts(items: DataFrame, category: str, about: DataFrame) -> DataFrame:
    """category, n: items of each category, its own about item (about: category, item_id) left out if it is its own."""
    n = items.groupBy(category).agg(F.count(F.lit(1)).alias("n_all"))
    own = about.join(items.select(category, "item_id"), [category, "item_id"], "left_semi").groupBy(category).agg(F.count(F.lit(1)).alias("n_about"))
    return n.join(own, category, "left").select(category, (F.col("n_all") - F.coalesce("n_about", F.lit(0))).alias("n"))


def conference_year(slug: Column, word: str) -> Column:
    """Year of a slug made of the word and four digits; null for others."""
    return F.nullif(F.regexp_extract(slug, f"^{word}([0-9]{{4}})$", 1), F.lit("")).cast("int")
