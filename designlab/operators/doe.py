"""Design workflow: a parameter space and every generator, linked columns and exports in one place.

    space = DesignSpace.from_json(spark, "space.json", koh=1.0)
    d = space.latin_hypercube(200, seed=1)          # DataFrame: design_id + parameters + linked columns
    space.save_csv(d, "out/lhs")                     # %.6g[unit] text cells
    space.save_param_list(d, "out/lhs_list")         # name "v1, v2, ..." [unit], a folder each

Samplers take a seed and are reproducible; rows come from ``spark.range`` so a
design of any size is generated on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from designlab.operators import design, space
from designlab.sources import files


@dataclass
class DesignSpace:
    spark: SparkSession
    params: list[space.Param]
    units: dict[str, str | None]
    koh: float | None = None
    use_lookup: bool = False

    @classmethod
    def from_json(cls, spark: SparkSession, path: str, koh: float | None = None,
                  use_lookup: bool = False) -> DesignSpace:
        """A1, A2: read the space file; parameters without values only name linked columns."""
        raw = space.read_space(spark, path)
        rows = raw.orderBy("pos").select("name", "unit", "convert_to").collect()     # parameter-sized
        units = {r["name"]: (r["convert_to"] or r["unit"]) for r in rows}
        return cls(spark, space.collect_params(space.scaled_levels(raw)), units, koh, use_lookup)

    @classmethod
    def from_table(cls, df: DataFrame, spec: list[space.TableParam], koh: float | None = None) -> DesignSpace:
        """A space whose levels are the distinct values of table columns."""
        params = space.collect_params(space.scaled_levels(space.space_from_table(df, spec)))
        units = {p.name: (p.convert_to or p.unit) for p in spec}
        for p in spec:
            for ln in p.linked:
                units.setdefault(ln, None)
        return cls(df.sparkSession, params, units, koh)

    # ------------------------------------------------------------ helpers

    @property
    def names(self) -> list[str]:
        return [p.name for p in self.params]

    @property
    def bounds(self) -> dict[str, tuple[float, float]]:
        return {p.name: (p.lo, p.hi) for p in self.params}

    def _ids(self, n: int) -> DataFrame:
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return self.spark.range(0, n, 1, parts).withColumnRenamed("id", "design_id")

    def with_links(self, df: DataFrame) -> DataFrame:
        """Linked columns of every parameter that declares them."""
        links, lookup = {}, {}
        for p in self.params:
            if p.linked:
                links[p.name] = (self.units.get(p.name), list(p.linked))
                if self.use_lookup:
                    for ln, vals in p.linked.items():
                        pairs = space.lookup_pairs(p.levels, vals)
                        if pairs:
                            lookup[ln] = pairs
        return space.with_linked(df, links, self.koh, lookup or None) if links else df

    # ------------------------------------------------------------ generators

    def full_factorial(self) -> DataFrame:
        return self.with_links(design.full_factorial(self.spark, {p.name: p.levels for p in self.params}))

    def grid(self, levels_per_param: int = 3) -> DataFrame:
        return self.with_links(design.grid(self.spark, self.bounds, levels_per_param))

    def fractional_factorial(self, base_design: str = "a b c ab ac bc abc") -> DataFrame:
        return self.with_links(design.fractional_factorial(self.spark, base_design, self.bounds))

    def random(self, samples: int = 20, seed: int = 42) -> DataFrame:
        return self.with_links(design.random_uniform(self._ids(samples), self.bounds, seed))

    def latin_hypercube(self, samples: int = 20, seed: int = 42) -> DataFrame:
        # ids are dense (spark.range), so strata come from keyed permutations: no shuffle
        return self.with_links(design.lhs_permuted(self._ids(samples), self.bounds, samples, seed))

    def maximin_latin_hypercube(self, samples: int = 20, iterations: int = 50, seed: int = 42,
                                scale: str = "physical") -> DataFrame:
        # candidates are generated and scored inside tasks: no shuffle
        best = design.maximin_lhs_generated(self.spark, self.bounds, samples, iterations, seed, scale=scale)
        return self.with_links(best.drop("iteration", "min_dist"))

    def sobol(self, samples: int = 20, seed: int | None = 42) -> DataFrame:
        return self.with_links(design.sobol(self._ids(samples), self.bounds, seed))

    def sobol_scrambled(self, samples: int = 20, seed: int = 42) -> DataFrame:
        return self.with_links(design.sobol_scrambled(self._ids(samples), self.bounds, seed))

    # ------------------------------------------------------------ sinks

    def save_csv(self, df: DataFrame, path: str) -> None:
        """A6."""
        files.write_design_csv(df, self.units, path)

    def save_param_list(self, df: DataFrame, path: str, legacy_round: bool = False) -> None:
        """A7."""
        cols = [c for c in df.columns if c != "design_id"]
        files.write_param_list(files.param_values(df, self.units, cols, legacy_round=legacy_round), path)
