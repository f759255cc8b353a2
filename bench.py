"""Headline operators at one data size; prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores,
``BENCH_RUNS`` the runs per operator (the smallest time counts; community
detection by modularity runs once).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from citegraph.operators.communities import community_stats, label_propagation  # noqa: E402
from citegraph.operators.dedupe import keep_last  # noqa: E402
from citegraph.operators.edges import citation_edges  # noqa: E402
from citegraph.operators.expand import expand_references  # noqa: E402
from citegraph.operators.graph import CitationGraph  # noqa: E402
from citegraph.operators.louvain import louvain  # noqa: E402
from citegraph.operators.normalize import normalize_works, to_vertices  # noqa: E402
from citegraph.operators.rank import author_influence, influence_rank  # noqa: E402
from citegraph.operators.render import render_nodes  # noqa: E402
from citegraph.operators.search import keyword_search, seed_ids  # noqa: E402
from citegraph.plans.materialize import materialize  # noqa: E402
from citegraph.plans.workflows import keyword_graph  # noqa: E402
from citegraph.sources.graph_store import load_graph, save_graph  # noqa: E402
from citegraph.sources.tables import works_from_tables  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    out = tempfile.mkdtemp(prefix="citegraph-bench-")
    times: dict[str, float] = {}

    def measure(name, run, repeat=runs):
        best, result = None, None
        for _ in range(repeat):
            start = time.time()
            result = run()
            spent = time.time() - start
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
        print(f"{name:24} {times[name]:8.2f} s", file=sys.stderr, flush=True)
        return result

    def save_and_load():
        save_graph(graph, "bench", out)
        back = load_graph(spark, "bench", out)
        return back.vertices.count(), back.edges.count()

    works = measure("works_from_tables", lambda: materialize(works_from_tables(spark, folder)))
    records = measure("normalize", lambda: materialize(normalize_works(works)))
    vertices = measure("dedupe_last_wins", lambda: materialize(to_vertices(keep_last(records))))
    edges = measure("citation_edges", lambda: materialize(citation_edges(vertices)))
    graph = CitationGraph(vertices, edges, closed=True)
    measure("keyword_search", lambda: keyword_search(records, "red gear", 100).count())
    measure("keyword_graph_central", lambda: keyword_graph(records, "red gear", 1000, central="W42").edges.count())
    measure("expand_2hop", lambda: expand_references(records, seed_ids(spark, ["W1", "W2", "W3"]), 2, 300).count())
    ranks = measure("influence_rank", lambda: influence_rank(graph))
    measure("author_influence", lambda: author_influence(graph, ranks).count())
    measure("label_propagation", lambda: materialize(label_propagation(graph)))
    communities = measure("louvain", lambda: materialize(louvain(graph)), repeat=1)
    stats = community_stats(edges, communities).first()
    measure("render_nodes", lambda: materialize(render_nodes(graph, ranks, communities)))
    measure("save_and_load", save_and_load)

    n_edges = edges.count()
    print(
        json.dumps(
            {
                "metric": "total time of the headline operators",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "vertices": vertices.count(),
                "edges": n_edges,
                "edges_per_second_per_rank_round": round(n_edges * 10 / times["influence_rank"]),
                "louvain_communities": stats["n_communities"],
                "louvain_modularity": round(stats["q"], 4),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
