"""The yearly graph, of which single years are rebuilt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators import facts, graph
from corvane.shared import written
from corvane.sources import sinks

SCHEMAS = {
    "all_relations": "source long, target long, year int", "company_years": "cw_id long, num_children long, num_parents long, top_parent_id long, year int",
    "company_relations": "source long, target long, year int", "distances": "n int, open boolean, year int",
}


class YearlyGraph:
    """Tables below a folder, in partitions by year: all_relations (the edges), company_years (degrees and top parent),
    company_relations (the edges without those to a top parent) and distances (how far the tops of a year are).

    All but one thing of a year follows from the year's rows. The step at which the search for top parents ends depends on the
    distances of all years; it matters to companies in cycles and to chains longer than it. Distances are kept, at most one row a
    step and year, so that a rebuild knows the step without the other years' edges; years that a changed step does reach are rebuilt, too.
    """

    def __init__(self, spark: SparkSession, folder: str, most_steps: int = 100):
        self._spark, self._folder, self._most = spark, folder.rstrip("/"), most_steps

    def table(self, name: str) -> DataFrame:
        """A table as it is stored; without rows before the first build."""
        if not sinks.Folder(self._spark, f"{self._folder}/{name}").has():
            return self._spark.createDataFrame([], SCHEMAS[name])
        return self._spark.read.schema(SCHEMAS[name]).parquet(f"{self._folder}/{name}")

    def rebuild(self, relations: DataFrame, filers: DataFrame, years: Sequence[int]) -> list[int]:
        """Makes the given years' partitions from relations (cw_id, parent_cw_id, year) and filers (cw_id, year); returns the years made.

        years has every year whose rows changed since its last build, all years at first; rows of other years are read only where the
        search's end reaches them. A year without rows loses its partitions. Rows without a year are left out. Distances are written
        last, so a rebuild that died is mended by repeating it.
        """
        if not years:
            return []
        stored = [tuple(r) for r in self.table("distances").select("year", "n", "open").collect()]  # at most one row a step and year
        made = sorted(set(years))
        while True:
            of = F.col("year").isin(made)
            edges = written(graph.distinct_edges(relations.filter(of), "cw_id", "parent_cw_id", "year"), "year-edges")
            info = written(facts.company_years(edges, filers.filter(of)), "company-years")
            found = graph.closure(info, edges, self._most)
            now = [tuple(r) for r in found.distances().collect()]
            end = lambda rows: graph.last_step({n for _, n, open_ in rows if not open_}, self._most)
            kept = [r for r in stored if r[0] not in made]
            before, steps = end(stored), end(kept + now)
            reached = {y for y, n, open_ in kept if open_ or n > min(before, steps)} if before != steps else set()
            if not reached:
                break
            made = sorted({*made, *reached})  # their distances stay, so the step does, and no more years follow
        out = written(graph.tops_with_degrees(found.tops(steps, merge=True), edges), "year-tops")
        for name, rows in (("all_relations", edges), ("company_years", out), ("company_relations", written(graph.cut_top_edges(edges, out), "year-cut")), ("distances", written(found.distances(), "distances", 1000))):
            kinds = [c.split() for c in SCHEMAS[name].split(", ")]
            sinks.rebuild_partitions(rows.select(*[F.col(c).cast(k) for c, k in kinds]), f"{self._folder}/{name}", "year", made)
        return made
