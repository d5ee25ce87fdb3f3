"""S1, S2, S3, S5, S9 with temporary files."""

import bz2
import datetime as dt
import json
import os

from conftest import rows

from cartoledger.plans.pipeline import save
from cartoledger.sources import files


def test_read_tsv_quotes_and_nulls(spark, tmp_path):
    p = tmp_path / "desc.txt"
    p.write_text(
        "hot_project\ttitle\tis_private\tis_archived\tis_draft\tchangeset_comment\n"
        '1\t""\tt\tf\tf\t\n'
        '2\t"say ""hi"""\tf\tt\tf\tback\\slash\n'
        '3\t"two\nlines"\tf\tf\tt\t"x"\n'
    )
    df = files.read_tsv(spark, str(p), "hot_project_description", multiline=True)
    got = {r.hot_project: r for r in df.collect()}
    assert got[1].title == "" and got[1].changeset_comment is None and got[1].is_private is True
    assert got[2].title == 'say "hi"' and got[2].changeset_comment == "back\\slash" and got[2].is_archived is True
    assert got[3].title == "two\nlines" and got[3].is_draft is True


def test_read_copy_text_unescapes(spark, tmp_path):
    p = tmp_path / "tags.txt"
    p.write_text("1\t1\t10\t2024-01-01 10:00:00\t5\tname\ta\\tb\\nc\n2\t1\t11\t2024-01-01 11:00:00\t\tnote\tback\\\\n\n")
    df = files.read_copy_text(spark, str(p), "node_tag_edits")
    got = {r.id: r for r in df.collect()}
    assert got[1].value == "a\tb\nc" and got[1].timestamp == dt.datetime(2024, 1, 1, 10)
    assert got[2].uid is None and got[2].value == "back\\n"


XML = """<?xml version="1.0" encoding="UTF-8"?>
<osm>
 <changeset id="1" created_at="2024-01-01T10:00:00Z" closed_at="2024-01-01T11:00:00Z" open="false" user="Savai&#39;i" uid="5" num_changes="3" comments_count="0">
  <tag k="comment" v="Mapping #hotosm-project-4"/>
  <tag k="created_by" v="JOSM/1.5"/>
 </changeset>
 <changeset id="2" created_at="2024-01-01T10:00:00Z" open="true" user="x" uid="6" num_changes="1" comments_count="0"/>
 <changeset id="3" created_at="2024-01-02T10:00:00Z" closed_at="2024-01-02T10:30:00Z" open="false" num_changes="0" comments_count="0"/>
 <changeset id="4" created_at="2024-01-03T10:00:00Z" closed_at="2024-01-03T10:30:00Z" open="false" user="y" uid="7" num_changes="2" comments_count="1"/>
</osm>
"""


def test_read_changesets_xml_bz2(spark, tmp_path):
    p = tmp_path / "changesets.osm.bz2"
    p.write_bytes(bz2.compress(XML.encode()))
    meta, rejects, tags = files.read_changesets(spark, str(p))
    m = {r.changeset: r for r in meta.collect()}
    assert set(m) == {1, 4}
    assert m[1].username == "Savai'i" and m[1].closed_at == dt.datetime(2024, 1, 1, 11)
    assert sorted(r.changeset for r in rejects.collect()) == [2, 3]
    assert rows(tags) == [(1, "comment", "Mapping #hotosm-project-4"), (1, "created_by", "JOSM/1.5")]


def test_read_regions_geojson(spark, tmp_path):
    sq = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
    hole = [[4, 4], [6, 4], [6, 6], [4, 6], [4, 4]]
    feats = [
        {"type": "Feature", "properties": {"id": "7"}, "geometry": {"type": "Polygon", "coordinates": [sq, hole]}},
        {"type": "Feature", "properties": {"id": "8"}, "geometry": {"type": "MultiPolygon", "coordinates": [[sq], [[[20, 20], [21, 20]]]]}},
        {"type": "Feature", "properties": {"id": "7"}, "geometry": {"type": "Polygon", "coordinates": [[[30, 30], [31, 30], [31, 31], [30, 30]]]}},
    ]
    p = tmp_path / "regions.geojsonl"
    p.write_text("\n".join(json.dumps(f) for f in feats) + "\n")
    reg = {r.hot_project: r.geom for r in files.read_regions(spark, str(p)).collect()}
    assert len(reg[7]) == 2 and len(reg[7][0]) == 2  # two parts, the first with a hole
    assert len(reg[8]) == 2 and len(reg[8][1][0]) == 2  # a ring with too few points is kept as data
    from cartoledger.operators import assign

    edges = {r.hot_project: len(r.edges) for r in assign.region_edges(files.read_regions(spark, str(p))).collect()}
    assert edges == {7: 8 + 3, 8: 4 + 1}


def test_save_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    back = save(df, str(tmp_path / "t"))
    assert rows(back) == [(1, "a"), (2, None)]
    files.export_csv(back.select("k"), str(tmp_path / "ids"))
    assert any(n.endswith(".csv") for n in os.listdir(tmp_path / "ids"))
