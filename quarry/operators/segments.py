"""A stored corpus of segments: tables by segment, and manifests that say which segments make it up.

Under one folder lie

* ``postings/segment=<name>``: (term, doc_id, tf) of the versions that the segment holds,
* ``docs/segment=<name>``: (doc_id, commit_id, op): which versions it holds, and its deletes,
* ``manifests/version=<n>``: one row per segment of that version of the corpus.

Segments are never changed in place. A commit, a merge or a compaction writes new segments and then the
next manifest; readers take the newest manifest that Spark has marked complete (``_SUCCESS``), so they
see all of a change or nothing, and a change that fails midway leaves the corpus as it was. Writing
overwrites single partitions (dynamic partition overwrite), so a repeated attempt replaces what a failed
one left, and no other segment's files. ``vacuum`` deletes the folders that no kept manifest names.

A document's live version is its last upsert, unless a later commit deletes it (see ``lifecycle``).
Merging drops dead versions but keeps deletes, which may still hide versions in other segments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import index as I
from quarry.operators import lifecycle as L
from quarry.operators.util import one_row

SCHEMAS = {
    "postings": "term string, doc_id long, tf long, segment string",
    "docs": "doc_id long, commit_id long, op string, segment string",
    "manifest": "segment string, last_commit long, n_docs long, n_postings long",
}


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- files --------------------------------------------------------------------------------

    def _folder(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _children(self, path: str) -> list[str]:
        fs, p = self._folder(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self) -> list[int]:
        """Complete manifests, oldest first."""
        out = []
        for name in self._children(f"{self.path}/manifests"):
            if name.startswith("version=") and "_SUCCESS" in self._children(f"{self.path}/manifests/{name}"):
                out.append(int(name.split("=")[1]))
        return sorted(out)

    def manifest(self, version: int | None = None) -> DataFrame:
        """The segments of a version (default: the newest)."""
        found = self.versions()
        if version is None:
            version = found[-1] if found else None
        if version is None:
            return self.spark.createDataFrame([], SCHEMAS["manifest"])
        return self.spark.read.schema(SCHEMAS["manifest"]).parquet(f"{self.path}/manifests/version={version}")

    def segments(self, version: int | None = None) -> list[str]:
        """Names of a version's segments: merges keep them few."""
        return sorted(r["segment"] for r in self.manifest(version).select("segment").collect())

    def table(self, name: str, segments: list[str]) -> DataFrame:
        """Rows of the given segments; only their folders are read."""
        if not self._children(f"{self.path}/{name}"):
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}").where(F.col("segment").isin(segments))

    def _write(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("segment").parquet(f"{self.path}/{name}")

    def _publish(self, rows: DataFrame) -> int:
        """Write the next manifest. A second writer of the same version fails, as its folder exists."""
        version = (self.versions() or [-1])[-1] + 1
        fs, p = self._folder(f"{self.path}/manifests/version={version}")
        if fs.exists(p) and "_SUCCESS" not in self._children(p.toString()):
            fs.delete(p, True)  # what an attempt left that never became visible
        rows.coalesce(1).write.parquet(f"{self.path}/manifests/version={version}")
        return version

    def _described(self, segments: list[str], last: DataFrame) -> DataFrame:
        """Manifest rows of new segments; ``last``: (segment, last_commit)."""
        n = F.count(F.lit(1))
        docs = self.table("docs", segments).where("op = 'upsert'").groupBy("segment").agg(n.alias("n_docs"))
        postings = self.table("postings", segments).groupBy("segment").agg(n.alias("n_postings"))
        zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
        return last.join(docs, "segment", "left").join(postings, "segment", "left").select("segment", "last_commit", zero("n_docs"), zero("n_postings"))

    # ---- changes ------------------------------------------------------------------------------

    def append(self, log: DataFrame) -> int:
        """Add the log's commits (commit_id, doc_id, op, title, seq), each as a segment of its own named by
        its number. Commits that the corpus already holds are skipped, so appending the same log again,
        or a longer one, adds what is new."""
        done = self.manifest().agg(F.max("last_commit")).first()[0]
        new = log if done is None else log.where(F.col("commit_id") > done)
        commits = [r[0] for r in new.select("commit_id").distinct().collect()]
        if not commits:
            return (self.versions() or [self._publish(self.manifest())])[-1]
        name = F.col("commit_id").cast("string").alias("segment")
        upserts = L.upserts_per_commit(new)
        keyed = upserts.select(F.struct("doc_id", name).alias("version"), "title")
        postings = I.build_tf_postings(keyed, "version", "title").select("term", "doc_id.doc_id", F.col("tf").cast("long").alias("tf"), "doc_id.segment")
        self._write("postings", postings.hint("rebalance", "segment"))
        deletes = new.where("op = 'delete'").select("doc_id", "commit_id", "op").distinct()
        docs = upserts.select("doc_id", "commit_id", F.lit("upsert").alias("op")).unionByName(deletes)
        self._write("docs", docs.select("*", name).hint("rebalance", "segment"))
        last = self.spark.createDataFrame([(str(c), c) for c in commits], "segment string, last_commit long")
        old = self.manifest()
        return self._publish(old.unionByName(self._described([str(c) for c in commits], last)))

    def live(self, version: int | None = None) -> DataFrame:
        """(doc_id, commit_id, segment) of the live documents, one aggregate over the narrow table."""
        docs = self.table("docs", self.segments(version))
        upsert = F.col("op") == "upsert"
        keys = docs.groupBy("doc_id").agg(
            F.max(F.when(upsert, F.struct("commit_id", "segment"))).alias("w"), F.max(F.when(~upsert, F.col("commit_id"))).alias("d")
        )
        keys = keys.where("w IS NOT NULL AND (d IS NULL OR d <= w.commit_id)")
        return keys.select("doc_id", "w.commit_id", "w.segment")

    def live_counts(self, version: int | None = None) -> DataFrame:
        """(segment, last_commit, n_live), with segments of no live document."""
        n = self.live(version).groupBy("segment").agg(F.count(F.lit(1)).alias("n_live"))
        rows = self.manifest(version).select("segment", "last_commit").join(n, "segment", "left")
        return rows.select("segment", "last_commit", F.coalesce("n_live", F.lit(0)).alias("n_live"))

    def live_postings(self, version: int | None = None) -> DataFrame:
        """(term, doc_id, tf, segment) of live versions."""
        rows = self.table("postings", self.segments(version))
        return rows.join(self.live(version).select("doc_id", "segment"), ["doc_id", "segment"], "left_semi").select("term", "doc_id", "tf", "segment")

    def merge(self, names: list[str]) -> int:
        """Rewrite the segments ``names`` as one that holds their live versions and all their deletes. Their
        own files stay until ``vacuum``, so readers of older versions go on."""
        old = self.manifest()
        known = {r["segment"]: r["last_commit"] for r in old.where(F.col("segment").isin(names)).collect()}
        if set(known) != set(names):
            raise ValueError(f"no such segments: {sorted(set(names) - set(known))}")
        merged = "+".join(sorted(names, key=lambda s: (known[s], s)))
        if len(merged) > 100:  # of many segments: the first and last, and the version that made it
            by = sorted(names, key=lambda s: (known[s], s))
            merged = f"{by[0].split('+')[0]}..{by[-1].split('+')[-1]}@{(self.versions() or [0])[-1] + 1}"
        name = F.lit(merged).alias("segment")
        live = self.live().where(F.col("segment").isin(names)).select("doc_id", "commit_id", "segment")
        rows = self.table("postings", names).join(live.select("doc_id", "segment"), ["doc_id", "segment"], "left_semi")
        self._write("postings", rows.select("term", "doc_id", "tf", name).hint("rebalance"))
        deletes = self.table("docs", names).where("op = 'delete'").groupBy("doc_id").agg(F.max("commit_id").alias("commit_id"))
        docs = live.select("doc_id", "commit_id", F.lit("upsert").alias("op")).unionByName(deletes.withColumn("op", F.lit("delete")))
        self._write("docs", docs.select("*", name).hint("rebalance"))
        last = self.spark.createDataFrame([(merged, max(known.values()))], "segment string, last_commit long")
        return self._publish(old.where(~F.col("segment").isin(names)).unionByName(self._described([merged], last)))

    def merge_two_smallest(self, at_most: int = L.MAX_SEGMENTS) -> int | None:
        """One maintenance step: with more than ``at_most`` segments, merge the two with the fewest live
        documents (ties: the later one first). None if there is nothing to do."""
        n = self.manifest().agg(F.count(F.lit(1)).alias("n"))
        two = self.live_counts().orderBy("n_live", F.desc("last_commit")).limit(2).crossJoin(one_row(n)).where(F.col("n") > at_most)
        names = [r["segment"] for r in two.collect()]
        return self.merge(names) if len(names) == 2 else None

    def compact(self) -> int:
        """Rewrite all segments as one."""
        names = self.segments()
        return self.merge(names) if names else self._publish(self.manifest())

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete manifests but the newest ``keep``, and the folders of segments that none of those name."""
        versions = self.versions()
        kept = versions[-keep:]
        named = {s for v in kept for s in self.segments(v)}
        for v in versions[:-keep]:
            fs, p = self._folder(f"{self.path}/manifests/version={v}")
            fs.delete(p, True)
        gone = []
        for table in ("postings", "docs"):
            for child in self._children(f"{self.path}/{table}"):
                if child.startswith("segment=") and _unescaped(child.split("=", 1)[1]) not in named:
                    fs, p = self._folder(f"{self.path}/{table}/{child}")
                    fs.delete(p, True)
                    gone.append(f"{table}/{child}")
        return gone


def _unescaped(name: str) -> str:
    """A partition folder's value as Spark reads it (it writes some characters as %XX)."""
    from urllib.parse import unquote

    return unquote(name)
