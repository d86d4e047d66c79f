"""Drive-like input tables derived from the given star-schema tables, as portable SQL text.

The same text runs in Spark and in DuckDB, so both sides of a check start from identical inputs. The text only states
the *inputs* (which file has which raw value, which key is absent, which is null); every result is computed by the
operators on one side and by the oracle's own SQL on the other.

In the texts, a third of all files and changes belongs to connection 1: the hot key the operators must survive.
"""

from __future__ import annotations

FILES = """
SELECT d.doc_id,
  'f' || d.doc_id AS id,
  d.lang, d.source AS origin, d.n_chars, d.text,
  'conn_' || CASE WHEN d.doc_id % 3 = 0 THEN 1 ELSE d.conn_key END AS connection_id,
  'cust' || lpad(CAST(CASE WHEN d.doc_id % 3 = 0 THEN 1 ELSE d.conn_key END AS STRING), 8, '0') AS customer_id,
  CASE WHEN d.doc_id % 59 = 0 THEN 'absent' WHEN d.doc_id % 47 = 0 THEN 'null' ELSE 'value' END AS mime_state,
  CASE d.doc_id % 12
    WHEN 0 THEN 'application/vnd.google-apps.document'
    WHEN 1 THEN 'application/vnd.google-apps.spreadsheet'
    WHEN 2 THEN 'application/vnd.google-apps.folder'
    WHEN 3 THEN 'application/vnd.google-apps.form'
    WHEN 4 THEN 'application/pdf'
    WHEN 5 THEN 'text/plain'
    WHEN 6 THEN 'image/heic'
    WHEN 7 THEN 'video/mp4'
    WHEN 8 THEN 'application/zip'
    WHEN 9 THEN 'application/vnd.google-apps.unknown'
    WHEN 10 THEN 'text/csv'
    ELSE 'application/octet-stream' END AS mime_value,
  CASE WHEN d.doc_id % 37 = 0 THEN 'absent' WHEN d.doc_id % 53 = 0 THEN 'null' ELSE 'value' END AS name_state,
  CASE WHEN d.doc_id % 61 = 0 THEN '' ELSE d.source || '-' || d.lang || '-' || d.doc_id END AS name_value,
  CASE WHEN d.doc_id % 43 = 0 THEN 'null'
       WHEN d.doc_id % 12 IN (0, 1, 2, 3, 9) THEN 'absent'
       WHEN d.doc_id % 67 = 0 THEN 'number'
       WHEN d.doc_id % 41 = 0 THEN 'bad'
       ELSE 'text' END AS size_state,
  d.n_chars * 4096 AS size_value,
  CASE WHEN d.doc_id % 3 <> 0 THEN 'absent' WHEN d.doc_id % 41 = 0 THEN 'bad' ELSE 'text' END AS quota_state,
  CASE WHEN d.doc_id % 109 = 0 THEN 'null' WHEN d.doc_id % 19 = 0 THEN 'absent' ELSE 'value' END AS parents_state,
  'f' || (12 * (d.doc_id % 16) + 2) AS parent_id,
  CASE WHEN d.doc_id % 101 = 0 THEN 'null' WHEN d.doc_id % 13 = 0 THEN 'absent'
       WHEN d.doc_id % 9 = 0 THEN 'two' ELSE 'one' END AS owners_state,
  c.c_custkey AS owner_key, c.c_name AS owner_name, c.c_custkey % 11 = 0 AS owner_unnamed,
  'c' || c.c_custkey || '@example.com' AS owner_email,
  's' || (d.doc_id % 7) || '@example.com' AS second_email,
  CASE WHEN d.doc_id % 103 = 0 THEN 'null' WHEN d.doc_id % 4 = 0 THEN 'absent' ELSE 'value' END AS user_state,
  CASE WHEN d.doc_id % 107 = 0 THEN 'null' WHEN d.doc_id % 6 = 0 THEN 'absent' ELSE 'value' END AS caps_state,
  d.doc_id % 2 = 0 AS can_edit, d.doc_id % 3 = 0 AS can_share, d.doc_id % 5 = 0 AS can_move,
  CASE WHEN d.doc_id % 29 = 0 THEN 'true' WHEN d.doc_id % 31 = 0 THEN 'null' WHEN d.doc_id % 2 = 0 THEN 'false'
       ELSE 'absent' END AS trashed_state,
  d.doc_id % 7 = 0 AS starred, d.doc_id % 3 = 1 AS shared, d.doc_id % 4 = 1 AS viewed, d.doc_id % 58 = 0 AS explicitly,
  '2024-01-' || lpad(CAST(d.doc_id % 28 + 1 AS STRING), 2, '0') || 'T10:00:00.' || lpad(CAST(d.doc_id % 1000 AS STRING), 3, '0') AS created_base,
  '2024-02-' || lpad(CAST(d.doc_id % 28 + 1 AS STRING), 2, '0') || 'T11:30:00' AS modified_base,
  CASE d.doc_id % 4 WHEN 0 THEN 'Z' WHEN 1 THEN '+00:00' WHEN 2 THEN '' ELSE '+02:00' END AS suffix,
  d.doc_id % 5 <> 0 AS has_link, d.doc_id % 12 IN (6, 7) AS has_thumbnail, d.doc_id % 2 = 0 AS has_version,
  d.doc_id % 12 IN (4, 5, 8, 10) AS has_md5, md5(d.text) AS md5_value,
  d.doc_id % 12 IN (0, 2) AS has_color,
  CASE WHEN d.doc_id % 5 = 0 THEN d.doc_id % 4 ELSE -1 END AS permission_rows,
  d.doc_id % 8 = 0 AS has_app_properties, d.doc_id % 10 = 0 AS has_properties
FROM (SELECT *, doc_id % (SELECT count(*) FROM {customer}) AS conn_key FROM {documents}) d
LEFT JOIN {customer} c ON c.c_custkey = d.conn_key
"""

CONNECTIONS = """
SELECT c_custkey,
  'conn_' || c_custkey AS connection_id,
  'cust' || lpad(CAST(c_custkey AS STRING), 8, '0') AS customer_id,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 'space' || (c_custkey % 50) END AS snowball_id,
  'c' || c_custkey || '@example.com' AS external_id,
  CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE c_nationkey % 5 <> 0 END AS sync_files,
  CASE WHEN c_custkey % 4 = 2 THEN NULL ELSE c_nationkey % 3 <> 0 END AS sync_folders,
  CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE c_custkey % 2 <> 0 END AS sync_shared_drives,
  c_name AS display_name, c_acctbal, c_mktsegment
FROM {customer}
"""

#: Versions of the connections: the stored one from the beginning, later ones with other spaces, emails taken from a
#: neighbour, and teardowns. A third of them belong to one connection.
CONNECTION_VERSIONS = """
SELECT connection_id, customer_id, snowball_id, external_id, sync_files, sync_folders, sync_shared_drives,
  CAST(NULL AS TIMESTAMP) AS valid_from, CAST(-1 AS BIGINT) AS version_seq, true AS active
FROM (""" + CONNECTIONS + """) c
UNION ALL
SELECT 'conn_' || k, 'cust' || lpad(CAST(k AS STRING), 8, '0'),
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'space_v' || (event_id % 20) END,
  CASE WHEN event_id % 4 = 0 THEN 'c' || ((k + 1) % 10) || '@example.com' WHEN event_id % 13 = 0 THEN NULL ELSE 'c' || k || '@example.com' END,
  event_id % 2 = 0, event_id % 3 = 0, CAST(NULL AS BOOLEAN), ts, CAST(event_id AS BIGINT), event_id % 5 <> 0
FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id % 10 END AS k FROM {events} WHERE event_id % 7 = 3) e
"""

CHANGES = """
SELECT e.event_id, e.event_id AS seq, e.ts,
  'conn_' || CASE WHEN e.event_id % 3 = 0 THEN 1 ELSE e.user_id % 10 END AS connection_id,
  e.event_id % (SELECT count(*) FROM {documents}) AS doc_id,
  'f' || (e.event_id % (SELECT count(*) FROM {documents})) AS file_id,
  e.event_type = 'error' AS removed,
  CASE WHEN e.event_type = 'signup' THEN 'drive' WHEN e.event_type = 'view' THEN NULL ELSE 'file' END AS raw_change_type,
  CAST(floor(e.event_id / 100.0) AS BIGINT) AS page_no,
  CASE WHEN e.event_id % 23 = 0 THEN 'none' WHEN e.event_id % 31 = 0 THEN 'empty' ELSE 'file' END AS file_state,
  e.user_id % 6 = 0 AS shared_drive
FROM {events} e
"""

CALLS = """
SELECT event_id, ts, 'conn_' || user_id AS connection_id,
  CASE user_id % 4 WHEN 0 THEN 'files.list' WHEN 1 THEN 'changes.list' WHEN 2 THEN 'files.get' ELSE 'files.export' END AS endpoint,
  CASE WHEN event_id % 43 = 0 THEN NULL WHEN event_type = 'error' THEN 429 WHEN event_type = 'purchase' THEN 503
       WHEN event_id % 37 = 0 THEN 401 WHEN event_id % 41 = 0 THEN 404 ELSE 200 END AS status_code,
  CASE event_id % 3 WHEN 0 THEN '30' WHEN 1 THEN 'soon' ELSE NULL END AS retry_after,
  value AS latency_ms,
  CASE event_id % 3 WHEN 0 THEN '{{"error":{{"code":404,"message":"File not found"}}}}'
       WHEN 1 THEN '{{"message":"gone"}}' ELSE 'plain failure text' END AS body
FROM {events}
"""

#: The API's answer to each attempt of each message: some call of the log.
ATTEMPTS = 3
RESPONSES = """
SELECT event_id, event_id - (SELECT min(event_id) FROM {events}) AS response_key, status_code, retry_after, body
FROM (""" + CALLS + """) c
"""

WEBHOOKS = """
SELECT e.event_id, e.event_id AS seq, e.ts, 'm' || e.event_id AS message_id,
  CASE WHEN e.event_id % 3 = 0 THEN 1 ELSE e.user_id % 10 END AS conn_key,
  CASE WHEN e.event_id % 5 = 0 THEN 'unknown' WHEN e.event_id % 7 = 0 THEN 'pending_lookup'
       ELSE 'conn_' || CASE WHEN e.event_id % 3 = 0 THEN 1 ELSE e.user_id % 10 END END AS message_connection_id,
  CASE WHEN e.event_id % 11 = 0 THEN NULL WHEN e.event_id % 13 = 0 THEN 'nobody@example.com'
       ELSE 'c' || CASE WHEN e.event_id % 3 = 0 THEN 1 ELSE e.user_id % 10 END || '@example.com' END AS email,
  e.event_id % 17 <> 0 AS has_channel,
  CASE WHEN e.event_id % 19 = 0 THEN 'drive#stop' ELSE 'api#channel' END AS kind,
  e.event_id % 29 <> 0 AS has_uri,
  e.event_id % 37 = 0 AS tokenless,
  e.event_id % 41 = 0 AS no_customer,
  e.event_id % 53 = 0 AS payload_is_text,
  CAST(floor(e.event_id / 100.0) AS BIGINT) AS page_no,
  e.event_id % 2 = 0 AS as_jsonrpc
FROM {events} e
"""

COMMANDS = """
SELECT o_orderkey AS seq, o_orderkey, o_custkey, o_orderdate AS ts, o_orderpriority, o_orderstatus, o_totalprice,
  'msg' || o_orderkey AS message_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'fetch' WHEN '2-HIGH' THEN 'write' WHEN '3-MEDIUM' THEN 'init'
       WHEN '4-NOT SPECIFIED' THEN 'teardown' ELSE CASE WHEN o_orderkey % 4 < 2 THEN 'webhook' ELSE 'other' END END AS verb,
  o_orderkey % 2 = 0 AS as_jsonrpc,
  CASE WHEN o_orderkey % 29 = 0 THEN 'mail' WHEN o_orderkey % 31 = 0 THEN '' ELSE 'drive' END AS provider,
  o_orderkey % 7 <> 0 AS has_customer,
  'cust' || lpad(CAST(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS STRING), 8, '0') AS customer_id,
  CASE WHEN o_orderkey % 11 = 0 THEN 'absent' WHEN o_orderkey % 23 = 0 THEN 'blank' ELSE 'value' END AS connection_state,
  'conn_' || CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS connection_id,
  CASE WHEN o_orderkey % 13 = 0 THEN 'playlists' WHEN o_orderkey % 5 = 0 THEN NULL
       ELSE CASE o_orderkey % 4 WHEN 0 THEN 'files' WHEN 1 THEN 'folders' WHEN 2 THEN 'changes' ELSE 'revisions' END END AS resource_type,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'explode_file'
       ELSE CASE o_orderkey % 5 WHEN 0 THEN 'upload_file' WHEN 1 THEN 'delete_file' WHEN 2 THEN 'move_file'
                                WHEN 3 THEN 'share_file' ELSE 'update_metadata' END END AS operation,
  o_orderkey % 37 = 0 AS wrong_action,
  CASE o_orderkey % 6 WHEN 0 THEN 'full_sync' WHEN 1 THEN 'incremental' WHEN 2 THEN 'poll' WHEN 3 THEN 'scheduled'
       WHEN 4 THEN NULL ELSE 'incremental' END AS trigger_type,
  CASE WHEN o_orderkey % 3 = 1 THEN 'space_m' || (o_orderkey % 9) WHEN o_orderkey % 3 = 2 THEN '' ELSE NULL END AS msg_snowball_id,
  CASE WHEN o_orderkey % 4 = 1 THEN 'm' || o_custkey || '@example.com' ELSE NULL END AS msg_external_id,
  CASE WHEN o_orderkey % 5 = 1 THEN 'msg-token' WHEN o_orderkey % 5 = 2 THEN '' ELSE NULL END AS msg_token,
  CASE WHEN o_orderkey % 8 = 3 THEN 5000 WHEN o_orderkey % 8 = 4 THEN 0 WHEN o_orderkey % 8 = 5 THEN NULL ELSE 250 END AS max_results,
  o_orderkey % 4 <> 3 AS has_webhook_url
FROM {orders}
"""

REVISIONS = """
SELECT 'f' || l_orderkey AS file_id, CAST(l_linenumber AS BIGINT) AS revision_no, l_shipdate, l_partkey, l_suppkey, l_extendedprice,
  'conn_' || CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS connection_id,
  'cust' || lpad(CAST(CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS STRING), 8, '0') AS customer_id,
  CASE WHEN l_partkey % 11 = 0 THEN 'null' WHEN l_partkey % 7 = 0 THEN 'absent' WHEN l_partkey % 13 = 0 THEN 'bad' ELSE 'text' END AS size_state,
  CAST(floor(l_extendedprice) AS BIGINT) AS size_value,
  l_returnflag = 'A' AS keep_forever, l_returnflag = 'N' AS has_published, l_linestatus = 'F' AS published,
  CASE WHEN l_suppkey % 41 = 0 THEN 'null' WHEN l_suppkey % 5 = 0 THEN 'absent' ELSE 'value' END AS user_state,
  'u' || l_suppkey || '@example.com' AS user_email,
  l_partkey % 4 = 0 AS has_links
FROM {lineitem}
"""

PERMISSION_ROWS = """
SELECT doc_id, quality, toxic, n, CASE WHEN second = 0 THEN doc_id % n ELSE (doc_id * 7 + 3) % n END AS holder
FROM (SELECT doc_id, quality, toxic, (SELECT count(*) FROM {customer}) AS n, 0 AS second FROM {labels}
      UNION ALL
      SELECT doc_id, quality, toxic, (SELECT count(*) FROM {customer}) AS n, 1 AS second FROM {labels}) u
WHERE second = 0 OR doc_id % n <> (doc_id * 7 + 3) % n
"""

PERMISSIONS = """
SELECT l.doc_id, 'f' || l.doc_id AS file_id, c.c_custkey,
  'p' || c.c_custkey AS permission_id,
  'conn_' || CASE WHEN l.doc_id % 3 = 0 THEN 1 ELSE l.doc_id % l.n END AS connection_id,
  'cust' || lpad(CAST(l.doc_id % l.n AS STRING), 8, '0') AS customer_id,
  CASE (l.doc_id + c.c_custkey) % 5 WHEN 0 THEN 'user' WHEN 1 THEN 'group' WHEN 2 THEN 'domain' WHEN 3 THEN 'anyone' ELSE NULL END AS kind,
  CASE c.c_custkey % 6 WHEN 0 THEN 'owner' WHEN 1 THEN 'organizer' WHEN 2 THEN 'fileOrganizer' WHEN 3 THEN 'writer' WHEN 4 THEN 'commenter' ELSE 'reader' END AS role,
  CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE c.c_name END AS display_name,
  'c' || c.c_custkey || '@example.com' AS email,
  l.quality = 1 AS discoverable, l.toxic = 1 AS deleted,
  l.doc_id % 4 = 0 AS expires, l.doc_id % 6 AS detail_kind
FROM (""" + PERMISSION_ROWS + """) l JOIN {customer} c ON c.c_custkey = l.holder
"""

COMMENTS = """
SELECT conv_id, turn, 'cm' || conv_id AS comment_id, 'f' || conv_id AS file_id, role AS author, text AS content,
  'conn_' || (conv_id % 10) AS connection_id,
  'cust' || lpad(CAST(conv_id % 10 AS STRING), 8, '0') AS customer_id,
  conv_id % 3 = 0 AS resolved, turn % 5 = 4 AS deleted,
  '2024-03-' || lpad(CAST(conv_id % 28 + 1 AS STRING), 2, '0') || 'T08:00:0' || (turn % 10) || '+00:00' AS created_raw
FROM {conversations}
"""

STATE = """
SELECT 'conn_' || user_id AS connection_id,
  CASE event_type WHEN 'view' THEN 'drive_page_token' WHEN 'click' THEN 'drive_channel_id'
    WHEN 'signup' THEN 'drive_channel_expiration' WHEN 'purchase' THEN 'drive_resource_id' ELSE 'drive_channel_token' END AS key,
  CASE event_type WHEN 'view' THEN CASE WHEN event_id % 50 = 0 THEN '' ELSE CAST(CAST(floor(event_id / 100.0) AS BIGINT) AS STRING) END
    WHEN 'signup' THEN CAST(1706745600000 + (event_id % 600 - 300) * 60000 AS STRING) ELSE 'v' || event_id END AS value,
  ts AS updated_at, event_id AS seq
FROM {events}
"""

WRITES = """
SELECT o_orderkey AS seq, 'cmd' || o_orderkey AS command_id,
  CASE o_orderkey % 16 WHEN 0 THEN 'create_file' WHEN 1 THEN 'upload_file' WHEN 2 THEN 'update_file' WHEN 3 THEN 'update_metadata'
    WHEN 4 THEN 'delete_file' WHEN 5 THEN 'trash_file' WHEN 6 THEN 'untrash_file' WHEN 7 THEN 'create_folder' WHEN 8 THEN 'copy_file'
    WHEN 9 THEN 'move_file' WHEN 10 THEN 'create_permission' WHEN 11 THEN 'share_file' WHEN 12 THEN 'update_permission'
    WHEN 13 THEN 'delete_permission' WHEN 14 THEN 'unshare_file' ELSE 'explode_file' END AS operation,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 41 = 0 THEN ''
       ELSE 'f' || ((o_custkey * 3 + o_orderkey) % (docs + 25)) END AS file_id,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'name ' || o_orderkey END AS name,
  CASE WHEN o_orderkey % 3 = 0 THEN 'text ' || o_orderkey ELSE NULL END AS description,
  CASE WHEN o_orderkey % 5 = 0 THEN 'text/plain' ELSE NULL END AS mime_type,
  CASE WHEN o_orderkey % 4 = 0 THEN 'f2' ELSE NULL END AS parent_folder_id,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'f' || (12 * (o_orderkey % 16) + 2) END AS new_parent_folder_id,
  CASE WHEN o_orderkey % 2 = 0 THEN 'f' || (12 * (((o_custkey * 3 + o_orderkey) % (docs + 25)) % 16) + 2) ELSE NULL END AS remove_parent,
  CASE WHEN o_orderkey % 43 = 0 THEN 'king' ELSE CASE o_orderkey % 3 WHEN 0 THEN 'writer' WHEN 1 THEN 'reader' ELSE 'commenter' END END AS role,
  CASE WHEN o_orderkey % 47 = 0 THEN 'robot' ELSE 'user' END AS type,
  'p' || (((o_custkey * 3 + o_orderkey) % (docs + 25)) % custs) AS permission_id,
  'w' || o_custkey || '@example.com' AS email_address
FROM (SELECT *, (SELECT count(*) FROM {documents}) AS docs, (SELECT count(*) FROM {customer}) AS custs FROM {orders}) o
"""

TABLES = {
    "files": FILES,
    "connections": CONNECTIONS,
    "connection_versions": CONNECTION_VERSIONS,
    "changes": CHANGES,
    "calls": CALLS,
    "responses": RESPONSES,
    "webhooks": WEBHOOKS,
    "commands": COMMANDS,
    "revisions": REVISIONS,
    "permissions": PERMISSIONS,
    "comments": COMMENTS,
    "state": STATE,
    "writes": WRITES,
}

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def duckdb_text(name: str) -> str:
    """The table's text over the plain table names."""
    return TABLES[name].format(**{t: t for t in BASE_TABLES}).strip()


def used_tables(name: str) -> list[str]:
    return [t for t in BASE_TABLES if "{" + t + "}" in TABLES[name]]
