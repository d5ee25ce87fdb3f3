"""The pipeline as composed DataFrames.

``Inputs`` holds the input tables (from files, or from the test-data adapter).
``Pipeline`` derives every table of the reference lazily; ``run`` writes them
in the reference's order and stops at the first failure (R1). The two tables
everything downstream reads (``changeset``, ``changeset_hot_project``) are
written and read back (R2), which also cuts the lineage of later steps.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import assign, changesets, checks, contributions, contributors, history, regioncells, sessions, stats
from ..session import stage, stage_with_metrics
from ..sources import adapter, files, tables


class Inputs:
    """Input tables of the pipeline, built on first use.

    Pass DataFrames (for example from ``sources.files``) or zero-argument
    callables that return them; callables run once, when a step needs the table.
    """

    NAMES = (
        "registered_names", "uid_username", "history_contributor", "description", "activity", "region",
        "node_edits", "way_edits", "rel_edits", "node_tag_edits", "way_tag_edits", "rel_tag_edits",
        "meta", "meta_tags", "rejects", "history", "tag_history",
    )

    def __init__(self, spark: SparkSession, **tables):
        unknown = set(tables) - set(self.NAMES)
        if unknown:
            raise TypeError(f"unknown input tables: {sorted(unknown)}")
        self.spark = spark
        self._src = tables
        self._df: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in Inputs.NAMES:
            raise AttributeError(name)
        if name not in self._df:
            if name in self._src:
                src = self._src[name]
                self._df[name] = src() if callable(src) else src
            elif name == "uid_username" and self.has("history"):
                self._df[name] = history.uid_username(self.history)  # H1
            elif name == "history_contributor" and self.has("meta", "meta_tags"):
                self._df[name] = contributors.tagged_contributors(self.meta, self.meta_tags)  # S4
            else:
                raise ValueError(f"input table {name!r} was not given")
        return self._df[name]

    def has(self, *names: str) -> bool:
        """Whether all the named tables were given."""
        return all(n in self._src for n in names)

    @classmethod
    def from_paths(cls, spark: SparkSession, changesets_xml: str | None = None, **paths: str) -> "Inputs":
        """Inputs from files in the formats the reference loads (see ``sources.files.FORMATS``).

        ``paths`` maps input names (``registered_names``, ``uid_username``, ``node_edits`` ...) to
        paths. ``changesets_xml`` is the changeset dump; it supplies ``meta``, ``meta_tags`` and
        ``rejects`` (incomplete changesets) unless they are given as files. Without a file,
        ``uid_username`` comes from ``history`` (H1) and ``history_contributor`` from the changeset
        comments (S4). Tables are read when a step first needs them.
        """
        src: dict = {}
        for name, path in paths.items():
            if name not in files.FORMATS:
                raise TypeError(f"no file format known for input {name!r}")
            src[name] = (lambda n=name, p=path: files.read_input(spark, n, p))
        if changesets_xml is not None:
            dump: dict = {}

            def part(i: int):
                if "t" not in dump:
                    dump["t"] = files.read_changesets(spark, changesets_xml)
                return dump["t"][i]

            src.setdefault("meta", lambda: part(0))
            src.setdefault("rejects", lambda: part(1))
            src.setdefault("meta_tags", lambda: part(2))
        return cls(spark, **src)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Inputs":
        a = adapter

        def bind(fn):
            return lambda: fn(spark, sf_dir)

        return cls(
            spark,
            registered_names=bind(a.registered_contributor_names),
            uid_username=bind(a.uid_username),
            history_contributor=bind(a.history_contributors),
            description=bind(a.project_description),
            activity=bind(a.project_activity),
            region=bind(a.project_region),
            node_edits=bind(a.node_edits),
            way_edits=bind(a.way_edits),
            rel_edits=bind(a.rel_edits),
            meta=bind(a.changeset_meta),
            meta_tags=bind(a.changeset_meta_tags),
            history=bind(a.history),
            tag_history=bind(a.tag_history),
        )


class Pipeline:
    """Every derived table of the reference, as lazily composed DataFrames."""

    def __init__(self, inputs: Inputs, staged: bool = True):
        self.i = inputs
        self.staged = staged
        self.run_id = uuid.uuid4().hex

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        """Store a table that several later steps read (see ``session.stage``)."""
        return stage(df, name, self.run_id) if self.staged else df

    # contributors (stage 4)
    @cached_property
    def registered(self) -> DataFrame:
        return contributors.registered(self.i.registered_names, self.i.uid_username)

    @cached_property
    def contributor(self) -> DataFrame:
        return self._stage(contributors.combined(self.registered, self.i.history_contributor), "contributor")

    @cached_property
    def uid_list(self) -> DataFrame:
        return contributors.uid_list(self.contributor)

    # project info (stage 5)
    @cached_property
    def project_tags(self) -> DataFrame:
        return changesets.project_tags(self.i.description)

    # geojoin (stage 10)
    @cached_property
    def changeset(self) -> DataFrame:
        return self._stage(changesets.rollup(self.i.node_edits, self.i.way_edits, self.i.rel_edits), "changeset")

    @cached_property
    def areas(self) -> DataFrame:
        """Visible projects with a valid region within the world: period, edges, extent."""
        return self._stage(assign.project_areas(self.i.region, self.i.activity, self.i.description), "project_areas")

    @cached_property
    def cells(self) -> DataFrame:
        """Cell index of the regions of ``areas``.

        When stored, the write also measures its edges and rows, the bound the
        assignment needs before broadcasting it.
        """
        df = regioncells.region_cells(self.areas)
        if not self.staged:
            return df
        size = F.coalesce(F.sum(F.size("edges") + 1), F.lit(0)).alias("n")
        stored, m = stage_with_metrics(df, "region_cells", [size], self.run_id)
        self.cells_total = int(m["n"])
        return stored

    @cached_property
    def assigned(self) -> DataFrame:
        """Changeset rows with hot_project (J8 + J10 in one pass)."""
        cells = self.cells
        return self._stage(
            assign.assign_to_areas(
                self.changeset, self.areas, self.contributor, cells=cells,
                cells_total=getattr(self, "cells_total", None),
            ),
            "assigned",
        )

    @cached_property
    def changeset_project(self) -> DataFrame:
        return self.assigned.select("changeset", "hot_project")

    # changeset tags (stage 11)
    @cached_property
    def editor(self) -> DataFrame:
        return changesets.editors(self.changeset, self.i.meta_tags)

    @cached_property
    def comment(self) -> DataFrame:
        return changesets.comments(self.i.meta_tags)

    # sessions (stage 12)
    @cached_property
    def session_rows(self) -> DataFrame:
        return self._stage(sessions.sessionize(self.assigned), "session_rows")

    @cached_property
    def session_size(self) -> DataFrame:
        return self._stage(sessions.sizes(self.session_rows), "session_size")

    @cached_property
    def session(self) -> DataFrame:
        return self._stage(sessions.labour(self.session_size), "session")

    # contributions (stage 13)
    @cached_property
    def first_contribution(self) -> DataFrame:
        return self._stage(contributions.first_contribution(self.session), "first_contribution")

    @cached_property
    def prior_experience(self) -> DataFrame:
        return contributions.prior_experience(self.first_contribution, self.changeset)

    @cached_property
    def totals(self) -> DataFrame:
        return contributions.totals(self.first_contribution, self.session)

    # stats (defined, not in the main run: R4)
    def monthly(self) -> DataFrame:
        return stats.monthly(self.assigned)

    def top_projects(self, n: int = stats.TOP_PROJECTS) -> DataFrame:
        return stats.top_projects(self.assigned, self.i.description, n)

    def derived_tables(self) -> dict[str, DataFrame]:
        return {
            "hot_project_registered_contributor": self.registered,
            "hot_project_contributor": self.contributor,
            "hot_project_changeset_tag": self.project_tags,
            "changeset": self.changeset,
            "changeset_hot_project": self.changeset_project,
            "changeset_editor": self.editor,
            "changeset_comment": self.comment,
            "user_hmp_session_changeset": self.session_rows.select("uid", "hot_project", "session", "changeset"),
            "user_hmp_session": self.session,
            "user_first_hot_contribution": self.first_contribution,
            "user_prior_experience": self.prior_experience,
            "user_hot_contributions": self.totals,
        }

    def inventory(self) -> DataFrame:
        return stats.inventory(self.derived_tables())

    def sizes(self) -> DataFrame:
        """Bytes on disk and rows of every derived table, stored for it where it is not yet."""
        folders = {}
        for name, df in self.derived_tables().items():
            files_ = stage(df, f"sized_{name}", self.run_id).inputFiles()
            folders[name] = files_[0].rsplit("/", 1)[0] if files_ else None
        return tables.sizes(self.i.spark, {k: v for k, v in folders.items() if v})

    # history filters (stages 6 and 9)
    def user_edits(self, kind: str) -> DataFrame:
        return history.user_edits(self.i.history, self.uid_list, kind)

    def user_tag_edits(self, kind: str) -> DataFrame:
        return history.user_tag_edits(self.i.tag_history, self.uid_list, kind)

    def way_deletions(self) -> DataFrame:
        return history.way_deletions(self.i.history, self.way_ids)

    @cached_property
    def way_ids(self) -> DataFrame:
        return self._stage(changesets.way_id_list(self.i.way_edits), "way_ids")

    # input name -> declared table, for the NOT NULL checks
    _DECLARED = {
        "registered_names": "hot_project_registered_contributor_name", "uid_username": "uid_username",
        "history_contributor": "hot_project_history_contributor", "description": "hot_project_description",
        "activity": "hot_project_activity", "node_edits": "node_edits", "way_edits": "way_edits",
        "rel_edits": "rel_edits", "meta": "changeset_meta", "meta_tags": "changeset_meta_tags",
    }

    def checks(self) -> dict[str, DataFrame]:
        """Offending rows per constraint of the reference (empty DataFrames when the data are clean)."""
        return self.input_checks() | {
            "contributor": checks.duplicates(self.contributor, ["hot_project", "uid"]),
            "session": checks.duplicates(self.session, ["uid", "hot_project", "session"]),
            "changeset_not_null": checks.null_violations_of(self.changeset, "changeset"),
        }

    def input_checks(self) -> dict[str, DataFrame]:
        """C1, C2, C4, C5 and C7 on the inputs."""
        out = {
            "uid_username_by_username": checks.duplicates(self.i.uid_username, ["username"]),
            "uid_username_by_uid": checks.duplicates(self.i.uid_username, ["uid"]),
            "description": checks.duplicates(self.i.description, ["hot_project"]),
            "activity": checks.duplicates(self.i.activity, ["hot_project"]),
            "changeset_meta": checks.duplicates(self.i.meta, ["changeset"]),
        }
        for name, table in self._DECLARED.items():
            if name in self.i._src:
                out[f"{name}_not_null"] = checks.null_violations_of(getattr(self.i, name), table)
        return out


def save(df: DataFrame, path: str) -> DataFrame:
    """Store a derived table in place of an older one, as a whole, and return the stored table."""
    return tables.replace_table(df, path)


class ConstraintError(RuntimeError):
    """A constraint of the declared tables does not hold; the run stops."""


def require(name: str, offending: DataFrame) -> None:
    """Stop if a check (C1-C7) returns a row."""
    row = offending.head(1)
    if row:
        raise ConstraintError(f"{name}: {row[0]}")


def run(inputs: Inputs, out_dir: str, check: bool = True) -> dict[str, str]:
    """Write every table under ``out_dir`` in the reference's stage order; any failure raises and stops the run.

    Each table is written once and read back, so later stages start from
    stored tables (R2). Input constraints are checked first and keys of derived
    tables as they are written (``check=False`` leaves that out). Tables that
    need the edit histories are written where those are given. What the
    sessionizer keeps aside is removed at the end. Returns table name -> folder of
    its Parquet files; ``tables.read_table`` finds the current ones of ``out_dir/name``.
    """
    out = out_dir.rstrip("/")
    paths: dict[str, str] = {}
    p = Pipeline(inputs, staged=False)

    def put(name: str, df: DataFrame, unique: list[str] | None = None) -> DataFrame:
        stored = save(df, f"{out}/{name}")
        paths[name] = tables.table_folder(inputs.spark, f"{out}/{name}")
        if check and unique:
            require(name, checks.duplicates(stored, unique))
        return stored

    if check:
        for name, offending in p.input_checks().items():
            require(name, offending)
    if inputs.has("meta") and inputs.has("meta_tags"):
        inputs._df["meta"] = put("changeset_meta", inputs.meta)
        inputs._df["meta_tags"] = put("changeset_meta_tags", inputs.meta_tags)
    if inputs.has("rejects"):
        put("changeset_rejects", inputs.rejects)
    p.registered = put("hot_project_registered_contributor", p.registered)
    p.contributor = put("hot_project_contributor", p.contributor)
    if check:
        require("hot_project_contributor", checks.duplicates(p.contributor, ["hot_project", "uid"]))
    paths["uid_list"] = f"{out}/uid_list"
    files.export_csv(p.uid_list, paths["uid_list"])
    put("hot_project_changeset_tag", p.project_tags)
    for kind in ("node", "way", "rel"):
        if inputs.has("history"):
            put(f"{kind}_edit_history", p.user_edits(kind))
        if inputs.has("tag_history"):
            put(f"{kind}_tag_edit_history", p.user_tag_edits(kind))
        if inputs.has(f"{kind}_tag_edits"):
            put(f"{kind}_tag_edits", getattr(inputs, f"{kind}_tag_edits"))
    box = geo.bbox_wkt("min_lat", "max_lat", "min_lon", "max_lon").alias("bbox")
    p.changeset = put("changeset", p.changeset.select("*", box), ["changeset"]).drop("bbox")
    if check:
        require("changeset_not_null", checks.null_violations_of(p.changeset, "changeset"))
    p.areas = put("project_areas", p.areas, ["hot_project"])
    p.cells = put("project_region_cells", p.cells, regioncells.KEY)
    p.assigned = put("changeset_assigned", p.assigned)
    put("changeset_hot_project", p.changeset_project)
    paths["way_id_list"] = f"{out}/way_id_list"
    p.way_ids = put("way_ids", p.way_ids)
    files.export_csv(p.way_ids, paths["way_id_list"])
    if inputs.has("history"):
        put("way_deletions", p.way_deletions())
    put("changeset_editor", p.editor)
    put("changeset_comment", p.comment)
    p.session_rows = put("user_hmp_session_rows", p.session_rows.drop("time_since_prev_cs"))
    put("user_hmp_session_changeset", p.session_rows.select("uid", "hot_project", "session", "changeset"))
    p.session_size = put("user_hmp_session_size", p.session_size)
    p.session = put("user_hmp_session", p.session, ["uid", "hot_project", "session"])
    p.first_contribution = put("user_first_hot_contribution", p.first_contribution, ["uid"])
    put("user_prior_experience", p.prior_experience)
    put("user_hot_contributions", p.totals)
    return paths
