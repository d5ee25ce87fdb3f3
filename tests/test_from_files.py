"""End to end from files in the reference's load formats (S1, S2, S3, S5) to sessions."""

import json

from cartoledger.plans.pipeline import Inputs, Pipeline

XML = """<?xml version="1.0" encoding="UTF-8"?>
<osm>
 <changeset id="100" created_at="2024-01-02T10:00:00Z" closed_at="2024-01-02T11:00:00Z" user="ann" uid="7" num_changes="3" comments_count="0">
  <tag k="created_by" v="JOSM/1.5"/>
  <tag k="comment" v="roads #hotosm-project-5"/>
 </changeset>
 <changeset id="101" created_at="2024-01-02T12:30:00Z" closed_at="2024-01-02T12:40:00Z" user="ann" uid="7" num_changes="1" comments_count="0"/>
</osm>
"""


def _write(p, text):
    p.write_text(text)
    return str(p)


def test_pipeline_from_files(spark, tmp_path):
    sq = [[10.0, 10.0], [10.2, 10.0], [10.2, 10.2], [10.0, 10.2], [10.0, 10.0]]
    paths = dict(
        registered_names=_write(tmp_path / "names.tsv", "hot_project\tusername\tnum_tasks\n5\tann\t3\n"),
        uid_username=_write(tmp_path / "uids.txt", "7\tann\n8\tbob\n"),
        history_contributor=_write(tmp_path / "tagged.tsv", "hot_tag\thot_project\tuid\tusername\n#hotosm-project-5\t5\t8\tbob\n"),
        description=_write(
            tmp_path / "desc.tsv",
            "hot_project\ttitle\tis_private\tis_archived\tis_draft\tchangeset_comment\n5\tRoads\tf\tf\tf\t#hotosm-project-5\n",
        ),
        activity=_write(
            tmp_path / "act.tsv",
            "hot_project\tfirst_date\tlast_date\tperc_done\tperc_validated\n5\t2024-01-01 00:00:00\t2024-02-01 00:00:00\t50\t\n",
        ),
        region=_write(tmp_path / "regions.geojsonl", json.dumps(
            {"type": "Feature", "properties": {"id": "5"}, "geometry": {"type": "Polygon", "coordinates": [sq]}}) + "\n"),
        node_edits=_write(tmp_path / "nodes.txt",
                          "1\t1\t100\t2024-01-02 10:00:00\t7\t10.1\t10.1\tt\n"
                          "2\t1\t100\t2024-01-02 10:30:00\t7\t10.11\t10.12\tt\n"
                          "3\t2\t101\t2024-01-02 11:45:00\t7\t10.1\t10.1\tf\n"),
        way_edits=_write(tmp_path / "ways.txt", "9\t1\t100\t2024-01-02 11:00:00\t7\tt\n"),
        rel_edits=_write(tmp_path / "rels.txt", ""),
    )
    xml = tmp_path / "changesets.osm"
    xml.write_text(XML)
    p = Pipeline(Inputs.from_paths(spark, changesets_xml=str(xml), **paths))
    assert sorted((r.hot_project, r.uid, r.has_submitted_tasks) for r in p.contributor.collect()) == [(5, 7, True), (5, 8, False)]
    assert sorted(tuple(r) for r in p.changeset_project.collect()) == [(100, 5), (101, 5)]
    s = p.session.collect()
    assert len(s) == 1 and s[0].num_edits == 4 and s[0].node_edits == 3 and s[0].way_edits == 1
    assert s[0].first_date.isoformat() == "2024-01-02T10:00:00" and s[0].last_date.isoformat() == "2024-01-02T11:45:00"
    assert sorted((r.changeset, r.editor) for r in p.editor.collect()) == [(100, "JOSM"), (101, "Other")]
    assert [tuple(r) for r in p.project_tags.collect()] == [(5, "#hotosm-project-5")]
    assert p.totals.first().num_projects == 1
