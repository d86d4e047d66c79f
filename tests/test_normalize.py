import json

import pytest
from pyspark.sql import functions as F

from stratafile.operators import envelope as E
from stratafile.operators import normalize as P

FOLDER = "application/vnd.google-apps.folder"


def raw(spark, *objects, **extra):
    rows = [("conn", "cust", "file1", o if isinstance(o, str) else json.dumps(o)) for o in objects]
    return spark.createDataFrame(rows, "connection_id string, customer_id string, file_id string, raw_json string")


def files(spark, cfg, *objects):
    return [r.asDict(recursive=True) for r in P.normalize_files(raw(spark, *objects), cfg).collect()]


def test_minimal_file(spark, cfg):
    (row,) = files(spark, cfg, {"id": "1", "name": "n", "mimeType": "text/plain"})
    assert row["parent_ids"] == [] and row["owners"] == []
    assert not any(row[k] for k in ["trashed", "starred", "explicitly_trashed", "shared", "viewed_by_me"])
    assert all(v is None for v in row["timestamps"].values())
    assert row["size_bytes"] is None and row["quota_bytes_used"] is None and row["bad_row_reason"] is None


def test_object_without_known_keys_gets_defaults(spark, cfg):
    (row,) = files(spark, cfg, {"invalid": "data"})
    assert (row["id"], row["name"], row["mime_type"], row["category"]) == ("", "Unnamed", "application/octet-stream", "other")
    assert row["bad_row_reason"] is None and row["_metadata"]["original_field_count"] == 1


@pytest.mark.parametrize(
    "size,expected",
    [("12345", 12345), ("not_a_number", 0), (None, 0), (12.7, 12), ("12.7", 0), (77, 77), (" 5 ", 5), ("", 0)],
)
def test_size(spark, cfg, size, expected):
    (row,) = files(spark, cfg, {"id": "1", "size": size, "quotaBytesUsed": size})
    assert row["size_bytes"] == expected and row["quota_bytes_used"] == expected


def test_presence_and_null(spark, cfg):
    (row,) = files(spark, cfg, {"id": None, "name": None, "parents": None, "trashed": None,
                                "owners": [{"displayName": None}, {}], "capabilities": {"canEdit": None, "canMoveItemWithinDrive": True}})
    assert row["id"] is None and row["name"] is None and row["parent_ids"] is None and row["trashed"] is None
    assert [o["name"] for o in row["owners"]] == [None, "Unknown"]
    assert row["capabilities"]["can_edit"] is None and row["capabilities"]["can_move"] is True
    assert row["capabilities"]["can_copy"] is False


@pytest.mark.parametrize(
    "obj,reason",
    [
        ({"mimeType": None}, "mimeType is null"),
        ({"owners": None}, "owners is null"),
        ({"owners": [None]}, "owner is null"),
        ({"lastModifyingUser": None}, "lastModifyingUser is null"),
        ({"capabilities": None}, "capabilities is null"),
        ("[1, 2]", "not a JSON object"),
        ("broken", "not a JSON object"),
    ],
)
def test_quarantine(spark, cfg, obj, reason):
    df = P.normalize_files(raw(spark, obj, {"id": "good"}), cfg)
    good, bad = P.split_bad_rows(df)
    assert [r.bad_row_reason for r in bad.collect()] == [reason]
    assert [r.id for r in good.collect()] == ["good"]


def test_folder_color_only_for_folders(spark, cfg):
    a, b = files(spark, cfg, {"mimeType": FOLDER, "folderColorRgb": "#fff"}, {"mimeType": "text/plain", "folderColorRgb": "#fff"})
    assert (a["folder_color_rgb"], a["type"], b["folder_color_rgb"]) == ("#fff", "folder", None)


def test_light_form(spark):
    objects = [
        {"id": "1", "size": "", "owners": [{"emailAddress": "a@x", "displayName": "A"}, {"emailAddress": "b@x"}], "permissions": []},
        {"id": "2", "size": 0, "permissions": [{}, {}], "owners": []},
        {"id": "3", "size": "0"},
        {"id": "4", "size": "x"},
        {"id": "5", "size": 7.9},
    ]
    rows = {r.id: r for r in P.light_normalize_files(raw(spark, *objects)).collect()}
    assert [rows[k].size_bytes for k in "12345"] == [None, None, 0, None, 7]
    assert rows["1"].owner.email == "a@x" and rows["2"].owner is None
    assert rows["1"].permissions_count is None and rows["2"].permissions_count == 2
    assert rows["4"].bad_row_reason == "size is not an integer"
    with pytest.raises(Exception, match="size is not an integer"):
        P.light_normalize_files(raw(spark, *objects), fail_on_bad_size=True).collect()


def test_revision(spark, cfg):
    df = P.normalize_revisions(raw(spark, {"id": "r1", "size": "x", "keepForever": True, "modifiedTime": "2025-01-01T00:00:00+00:00",
                                           "exportLinks": {"application/pdf": "u"}}, {}), cfg)
    a, b = df.collect()
    assert (a.size_bytes, a.keep_forever, a.timestamps.modified_at, a.export_links) == (0, True, "2025-01-01T00:00:00Z", {"application/pdf": "u"})
    assert (b.id, b.size_bytes, b.published, b.source.revision_id) == ("", None, False, "")


def test_permission(spark, cfg):
    df = P.normalize_permissions(raw(spark, {"id": "p", "type": "user", "role": "writer", "permissionDetails": [{"role": "reader", "inherited": True}, {}]},
                                     {"permissionDetails": None}), cfg)
    a, b = df.collect()
    assert [d.inherited for d in a.permission_details] == [True, False] and a.display_name == ""
    assert (b.permission_type, b.bad_row_reason) == ("", "permissionDetails is null")


def test_comment(spark, cfg):
    replies = [{"id": "r1", "deleted": True, "author": {"displayName": "B"}}, {"content": "c", "createdTime": "2025-01-01T00:00:00+00:00"}]
    a, b = P.normalize_comments(raw(spark, {"id": "c1", "replies": replies, "author": {}}, {"id": "c2"}), cfg).collect()
    assert a.reply_count == 2 and [r.id for r in a.replies] == ["r1", ""] and a.replies[0].deleted
    assert a.replies[1].timestamps.created_at == "2025-01-01T00:00:00Z" and a.author.name == "Unknown"
    assert b.reply_count is None and b.replies is None


def test_text(spark, cfg):
    obj = {"id": "1", "name": "Q4", "mimeType": "application/vnd.google-apps.document", "size": "2048", "webViewLink": "https://l",
           "parents": ["a", "b"], "owners": [{"displayName": "Al"}, {}], "createdTime": "2025-01-01T00:00:00+00:00", "starred": True, "shared": True}
    df = P.normalize_files(raw(spark, obj, {"mimeType": FOLDER, "name": None}), cfg).select(E.render_text().alias("t"))
    a, b = [r.t for r in df.collect()]
    assert a == ("File: Q4\nType: Google Docs (document)\nSize: 2.00 KB\nLink: https://l\nParent folders: 2\nOwners: Al, Unknown\n"
                 "Created: 2025-01-01T00:00:00Z\nStatus: starred, shared")
    assert b == "File: None\nType: Folder"


def test_envelope_record(spark, cfg):
    df = P.normalize_files(raw(spark, {"id": "1", "name": "", "mimeType": "text/plain"}), cfg, keep=("connection_id", "customer_id"))
    batch = {"snowball_id": F.lit("s"), "batch_id": F.lit("b"), "batch_sequence": F.lit(0), "batch_is_last": F.lit(True),
             "batch_page_token": F.lit(None).cast("string"), "storage_path": F.lit("p/q"), "content_mime_type": F.lit("text/plain"), "content_bytes": F.lit(5)}
    record = json.loads(E.to_record(E.ingest_envelopes(df.withColumns(batch), cfg, content=True)).first().value)
    assert record["jsonrpc"] == "2.0" and record["method"] == "metadata.integration.content.ingest"
    parameters = record["params"]["header"]["parameters"]
    assert parameters["correlation_id"] == "drive:conn:file:1" and parameters["energy"] == 5
    assert parameters["space_path"] == "/cust/graph/snowball/s"
    assert [c["type"] for c in record["params"]["contents"]] == ["text", "file"]
    meta = record["params"]["metadata"]
    assert meta["resource_type"] == "file" and meta["has_content"] is True and meta["source_document_title"] == "(Untitled)"
