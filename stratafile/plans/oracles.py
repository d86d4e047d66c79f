"""DuckDB SQL for the registered queries, written from the rules and not from the operators."""

from __future__ import annotations

from stratafile.plans import facts

ORACLES: dict[str, str] = {}


def sql(name: str, tables: list[str], body: str) -> None:
    """Register ``body`` (which may start with more CTEs, each ended by a comma) over the named input tables."""
    ctes = ", ".join(f"{t} AS ({facts.duckdb_text(t)})" for t in tables)
    ORACLES[name] = f"WITH RECURSIVE {ctes}{body}"


NORM = """, norm0 AS (
  SELECT *,
    CASE mime_state WHEN 'absent' THEN 'application/octet-stream' WHEN 'value' THEN mime_value END AS mime_type,
    CASE name_state WHEN 'absent' THEN 'Unnamed' WHEN 'value' THEN name_value END AS name,
    CASE size_state WHEN 'null' THEN 0 WHEN 'bad' THEN 0 WHEN 'number' THEN n_chars WHEN 'text' THEN size_value END AS size_bytes,
    CASE WHEN owners_state IN ('one', 'two') THEN CASE WHEN owner_unnamed THEN 'Unknown' ELSE owner_name END END AS owner1,
    CASE WHEN mime_state = 'null' THEN 'mimeType is null' WHEN owners_state = 'null' THEN 'owners is null'
         WHEN user_state = 'null' THEN 'lastModifyingUser is null' WHEN caps_state = 'null' THEN 'capabilities is null' END AS bad,
    CASE suffix WHEN '+00:00' THEN 'Z' ELSE suffix END AS suffix_out,
    CASE parents_state WHEN 'absent' THEN '' WHEN 'value' THEN parent_id END AS parents,
    trashed_state = 'true' AS is_trashed,
    CASE trashed_state WHEN 'true' THEN true WHEN 'null' THEN NULL ELSE false END AS trashed
  FROM files
), norm AS (
  SELECT *,
    mime_type = 'application/vnd.google-apps.folder' AS is_folder,
    CASE WHEN mime_type = 'application/vnd.google-apps.folder' THEN 'folder' ELSE 'file' END AS type,
    mime_type IN ('application/vnd.google-apps.document', 'application/vnd.google-apps.spreadsheet',
                  'application/vnd.google-apps.folder', 'application/vnd.google-apps.form') AS is_native,
    CASE mime_type WHEN 'application/vnd.google-apps.document' THEN 'document' WHEN 'application/vnd.google-apps.spreadsheet' THEN 'spreadsheet'
      WHEN 'application/vnd.google-apps.folder' THEN 'folder' WHEN 'application/vnd.google-apps.form' THEN 'form'
      WHEN 'application/pdf' THEN 'document' WHEN 'text/plain' THEN 'document' WHEN 'image/heic' THEN 'image' WHEN 'video/mp4' THEN 'video'
      WHEN 'application/zip' THEN 'archive' WHEN 'text/csv' THEN 'spreadsheet' WHEN 'application/vnd.google-apps.unknown' THEN 'google-workspace'
      WHEN 'application/octet-stream' THEN 'other' END AS category,
    CASE mime_type WHEN 'application/vnd.google-apps.document' THEN 'text/plain' WHEN 'application/vnd.google-apps.spreadsheet' THEN 'text/csv' END AS export_format,
    CASE mime_type WHEN 'application/vnd.google-apps.document' THEN '.txt' WHEN 'application/vnd.google-apps.spreadsheet' THEN '.csv'
      WHEN 'application/pdf' THEN '.pdf' WHEN 'text/plain' THEN '.txt' WHEN 'video/mp4' THEN '.mp4' WHEN 'application/zip' THEN '.zip' WHEN 'text/csv' THEN '.csv' END AS extension,
    CASE owners_state WHEN 'one' THEN owner1 || '<' || owner_email || '>'
      WHEN 'two' THEN owner1 || '<' || owner_email || '>;Second Owner<' || second_email || '>' ELSE '' END AS owners_text,
    CASE WHEN has_link THEN 'https://drive.example/' || id END AS link,
    created_base || suffix_out AS created_at,
    CASE WHEN NOT explicitly THEN modified_base || suffix_out END AS modified_at
  FROM norm0
), good AS (SELECT * FROM norm WHERE bad IS NULL)
"""

# Fixed values of the checks.
OFFLOAD_BYTES = 8192
RECORD_BYTES = 1500
TTL_SECONDS = 864000
PAGE_TTL_SECONDS = 3600

sql("P01_normalize_files", ["files"], NORM + """
SELECT id, type, name, mime_type, category, is_folder, is_native AS is_google_workspace,
  export_format IS NOT NULL AS needs_export, export_format, extension AS file_extension, size_bytes, link AS web_view_link,
  CASE WHEN has_thumbnail THEN 'https://img.example/' || id END AS thumbnail_link, parents, owners_text AS owners,
  CASE WHEN user_state = 'value' THEN CASE WHEN owner_unnamed THEN 'Unknown' ELSE owner_name END END AS modified_by,
  CASE WHEN caps_state = 'value' THEN can_edit END AS can_edit,
  CASE WHEN caps_state = 'value' THEN can_move END AS can_move,
  CASE WHEN caps_state = 'value' THEN false END AS can_delete,
  trashed, starred, explicitly AS explicitly_trashed, shared, viewed AS viewed_by_me,
  created_at, modified_at,
  CASE WHEN viewed THEN modified_base || suffix_out END AS viewed_by_me_at,
  CASE WHEN shared THEN created_at END AS shared_with_me_at,
  CASE WHEN is_trashed THEN modified_base || suffix_out END AS trashed_at,
  CASE quota_state WHEN 'text' THEN n_chars WHEN 'bad' THEN 0 END AS quota_bytes_used,
  CASE WHEN has_version THEN CAST(doc_id AS VARCHAR) END AS version,
  CASE WHEN has_md5 THEN md5_value END AS md5_checksum,
  CASE WHEN doc_id % 5 = 0 THEN lang || ' document' END AS description,
  CASE WHEN is_folder AND has_color THEN '#8f8f8f' END AS folder_color_rgb,
  connection_id, 'drive' AS provider, '2024-02-01T00:00:00Z' AS transformed_at,
  CAST(4 + (name_state <> 'absent')::INT + (mime_state <> 'absent')::INT + (size_state <> 'absent')::INT + (quota_state <> 'absent')::INT
    + (NOT explicitly)::INT + 2 * viewed::INT + shared::INT + is_trashed::INT + has_link::INT + has_thumbnail::INT + has_version::INT
    + has_md5::INT + (doc_id % 5 = 0)::INT + has_color::INT + (parents_state <> 'absent')::INT + (owners_state <> 'absent')::INT
    + (user_state <> 'absent')::INT + (caps_state <> 'absent')::INT + (trashed_state <> 'absent')::INT + explicitly::INT
    + (permission_rows >= 0)::INT + has_app_properties::INT + has_properties::INT + (doc_id % 15 = 0)::INT AS BIGINT) AS field_count,
  permission_rows >= 0 AS has_permissions, has_app_properties, has_properties
FROM good""")

sql("F04_mime_classify", ["files"], """
SELECT id, m AS mime_type, category, category AS category_by_join, extension, export_format, is_native,
  export_format IS NOT NULL AS needs_export, native_name, CASE WHEN export_format IS NOT NULL THEN 'export' ELSE 'download' END AS read_mode
FROM (SELECT id, mime_value AS m,
  CASE doc_id % 12 WHEN 0 THEN 'document' WHEN 1 THEN 'spreadsheet' WHEN 2 THEN 'folder' WHEN 3 THEN 'form' WHEN 4 THEN 'document' WHEN 5 THEN 'document'
    WHEN 6 THEN 'image' WHEN 7 THEN 'video' WHEN 8 THEN 'archive' WHEN 9 THEN 'google-workspace' WHEN 10 THEN 'spreadsheet' ELSE 'other' END AS category,
  CASE doc_id % 12 WHEN 0 THEN '.txt' WHEN 1 THEN '.csv' WHEN 4 THEN '.pdf' WHEN 5 THEN '.txt' WHEN 7 THEN '.mp4' WHEN 8 THEN '.zip' WHEN 10 THEN '.csv' END AS extension,
  CASE doc_id % 12 WHEN 0 THEN 'text/plain' WHEN 1 THEN 'text/csv' END AS export_format,
  doc_id % 12 IN (0, 1, 2, 3) AS is_native,
  CASE doc_id % 12 WHEN 0 THEN 'Google Docs' WHEN 1 THEN 'Google Sheets' WHEN 3 THEN 'Google Forms' ELSE 'Google Workspace file' END AS native_name
  FROM files)""")

sql("P06_quarantine", ["files"], NORM + "SELECT id, bad AS bad_row_reason FROM norm WHERE bad IS NOT NULL")

LIGHT = """, light AS (
  SELECT *, CASE name_state WHEN 'value' THEN name_value END AS light_name,
    CASE mime_state WHEN 'value' THEN mime_value END AS light_mime,
    CASE size_state WHEN 'number' THEN n_chars WHEN 'text' THEN size_value END AS light_size,
    CASE WHEN mime_state = 'value' AND mime_value = 'application/vnd.google-apps.folder' THEN 'folder' ELSE 'file' END AS light_type,
    CASE WHEN owners_state IN ('one', 'two') THEN owner_email END AS light_owner_email,
    CASE WHEN owners_state IN ('one', 'two') AND NOT owner_unnamed THEN owner_name END AS light_owner_name,
    CASE trashed_state WHEN 'true' THEN true WHEN 'null' THEN NULL ELSE false END AS light_trashed,
    CASE size_state WHEN 'bad' THEN 'size is not an integer' END AS light_bad
  FROM files)
"""

sql("P05_light_normalize", ["files"], LIGHT + """
SELECT id, light_name AS name, light_mime AS mime_type, created_base || suffix AS created_at,
  CASE WHEN NOT explicitly THEN modified_base || suffix END AS modified_at, light_size AS size_bytes,
  CASE WHEN has_link THEN 'https://drive.example/' || id END AS web_view_link,
  CASE parents_state WHEN 'absent' THEN '' WHEN 'value' THEN parent_id END AS parents, light_trashed AS trashed, light_type AS type,
  light_owner_email AS owner_email, light_owner_name AS owner_name,
  CASE WHEN permission_rows > 0 THEN CAST(permission_rows AS BIGINT) END AS permissions_count, light_bad AS bad_row_reason
FROM light""")

TEXT = """, texts AS (
SELECT *, concat_ws(chr(10), 'File: ' || coalesce(name, 'None'),
  CASE WHEN is_folder THEN 'Type: Folder'
       WHEN is_native THEN 'Type: ' || CASE mime_type WHEN 'application/vnd.google-apps.document' THEN 'Google Docs'
            WHEN 'application/vnd.google-apps.spreadsheet' THEN 'Google Sheets' ELSE 'Google Forms' END || ' (' || category || ')'
       ELSE 'Type: ' || category END,
  CASE WHEN size_bytes IS NULL THEN NULL WHEN size_bytes / 1024.0 > 1024 THEN printf('Size: %.2f MB', size_bytes / 1024.0::DOUBLE / 1024.0)
       ELSE printf('Size: %.2f KB', size_bytes / 1024.0::DOUBLE) END,
  'Link: ' || link, CASE WHEN parents <> '' THEN 'Parent folders: 1' END,
  CASE owners_state WHEN 'one' THEN 'Owners: ' || owner1 WHEN 'two' THEN 'Owners: ' || owner1 || ', Second Owner' END,
  'Created: ' || created_at, 'Modified: ' || modified_at,
  CASE WHEN is_trashed OR starred OR shared THEN 'Status: ' || concat_ws(', ', CASE WHEN is_trashed THEN 'trashed' END,
       CASE WHEN starred THEN 'starred' END, CASE WHEN shared THEN 'shared' END) END) AS text_out
FROM good)
"""
sql("P16_render_text", ["files"], NORM + TEXT + "SELECT id, text_out AS text FROM texts")

sql("P17_metadata", ["files"], NORM + """
SELECT id AS drive_id, name, mime_type, category, is_folder, is_native AS is_google_workspace, trashed, starred,
  link AS source_document_url, coalesce(nullif(name, ''), '(Untitled)') AS source_document_title, export_format, size_bytes,
  link AS web_view_link, CASE WHEN has_thumbnail THEN 'https://img.example/' || id END AS thumbnail_link,
  nullif(parents, '') AS parent_ids, nullif(owners_text, '') AS owners, shared, created_at, modified_at
FROM good""")

READY = """, ready AS (
  SELECT g.*, c.snowball_id FROM good g JOIN connections c USING (connection_id)
  WHERE NOT is_trashed AND c.snowball_id IS NOT NULL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY connection_id ORDER BY id) - 1 AS pos, count(*) OVER (PARTITION BY connection_id) AS total FROM ready
)
"""
sql("Q01_fetch_files", ["files", "connections"], NORM + """, good_keep AS (SELECT * FROM good), good_text AS (SELECT 1)
""" + READY + TEXT.replace("FROM good)", "FROM ranked)") + """
SELECT connection_id, id, 'drive:' || connection_id || ':' || type || ':' || id AS nonce, pos // 100 AS page_no, pos % 100 AS batch_sequence,
  pos = total - 1 AS batch_is_last, CASE WHEN pos // 100 < (total - 1) // 100 THEN CAST(pos // 100 + 1 AS VARCHAR) END AS batch_page_token,
  '/' || customer_id || '/graph/snowball/' || snowball_id AS space_path,
  sha256('fetch|' || connection_id || '|' || (pos // 100)) AS batch_id, connection_id AS topic_key, length(text_out) AS text_chars
FROM texts""")

sql("X07_missing_space", ["connections"], """
SELECT 'req_' || connection_id AS request_id, connection_id, 'ValidationError' AS error_class, 'snowball_id' AS field
FROM connections WHERE snowball_id IS NULL""")

sql("P19_empty_batch", ["files", "connections"], NORM + """, requests AS (
  SELECT 'req_' || connection_id AS request_id, *, CASE WHEN c_custkey % 5 = 0 THEN 'more' END AS next_page_token FROM connections
  WHERE snowball_id IS NOT NULL AND connection_id NOT IN (SELECT connection_id FROM good WHERE NOT is_trashed)
)
SELECT request_id, connection_id, sha256('empty|' || request_id) AS batch_id,
  'drive:' || connection_id || ':files:empty:' || sha256('empty|' || request_id) AS correlation_id, 'empty_batch_files' AS resource_type,
  '/' || customer_id || '/graph/snowball/' || snowball_id AS space_path, '{"empty":true,"resource_type":"files"}' AS text,
  (c_custkey * 1500) // 1000 AS processing_duration_ms, next_page_token, next_page_token IS NOT NULL AS has_more,
  0 AS batch_sequence, next_page_token IS NULL AS batch_is_last
FROM requests""")

sql("S01_list_pages", ["files"], """
SELECT connection_id, doc_id // 100 AS page_no, id, row_number() OVER w - 1 AS batch_sequence,
  (row_number() OVER w = count(*) OVER (PARTITION BY connection_id, doc_id // 100)) AND (doc_id // 100) % 2 <> 0 AS batch_is_last,
  CASE WHEN (doc_id // 100) % 2 = 0 THEN 'n' || (doc_id // 100) END AS next_page_token,
  count(*) OVER (PARTITION BY connection_id, doc_id // 100) AS page_files
FROM files WINDOW w AS (PARTITION BY connection_id, doc_id // 100 ORDER BY doc_id)""")

sql("S04_file_lookup", ["files"], NORM + """
SELECT w.id, g.name, g.type, g.id IS NOT NULL AS found
FROM (SELECT DISTINCT 'f' || o_custkey AS id FROM orders) w LEFT JOIN good g ON g.id = w.id""")

ORACLES["S04_catalog_lookup"] = ORACLES["S04_file_lookup"]
sql("Q03_folders", ["files"], NORM + """, kids AS (
  SELECT parents AS id, count(*) AS children, count(*) FILTER (WHERE is_folder) AS subfolders, CAST(sum(coalesce(size_bytes, 0)) AS BIGINT) AS bytes
  FROM good WHERE NOT is_trashed AND parents <> '' GROUP BY 1)
SELECT g.id, g.name, g.parents, k.children, k.subfolders, k.bytes FROM good g LEFT JOIN kids k ON k.id = g.id WHERE g.is_folder AND NOT g.is_trashed""")

sql("X21_file_filters", ["files"], NORM + """
SELECT 'folder' AS filter, id FROM good WHERE parents = 'f26' AND NOT is_trashed
UNION ALL SELECT 'mime', id FROM good WHERE mime_type = 'text/plain'
UNION ALL SELECT 'folders_only', id FROM good WHERE is_folder AND NOT is_trashed""")

sql("X23_predicates", ["files"], NORM + """
SELECT id, mime_type, owners_text AS owners FROM good
WHERE (category = 'document' AND NOT is_trashed AND NOT explicitly
       AND (modified_base::TIMESTAMP - CASE WHEN suffix = '+02:00' THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END) > TIMESTAMP '2024-02-10 10:00:00')
   OR (owners_state IN ('one', 'two') AND owner_email = 'c7@example.com')""")

ELIGIBLE = """, elig AS (SELECT *, CASE WHEN is_folder THEN 'folder' WHEN mime_type = 'application/vnd.google-apps.form' THEN 'not_exportable'
    WHEN size_bytes > 52428800 THEN 'declared_too_large' END AS reason FROM good)
"""
sql("X11_content_eligibility", ["files"], NORM + ELIGIBLE + """
SELECT id, reason AS skip_reason, CASE WHEN export_format IS NOT NULL THEN 'export' ELSE 'download' END AS read_mode,
  CASE WHEN reason IS NULL THEN octet_length(encode(text)) END AS content_bytes, CASE WHEN reason IS NULL THEN sha256(text) END AS sha256
FROM elig""")

sql("A15_inventory", ["files"], NORM + """
SELECT category, type, CASE WHEN owners_state IN ('one', 'two') THEN owner_email ELSE 'none' END AS owner, count(*) AS files,
  CAST(sum(coalesce(size_bytes, 0)) AS BIGINT) AS bytes, count(*) FILTER (WHERE shared) AS shared_files
FROM good GROUP BY ALL""")

sql("A05_page_sizes", ["files"], NORM + """, r AS (
  SELECT connection_id, row_number() OVER (PARTITION BY connection_id ORDER BY id) - 1 AS pos, count(*) OVER (PARTITION BY connection_id) AS total
  FROM good WHERE NOT is_trashed)
SELECT connection_id, pos // 20 AS page_no, count(*) AS files, max(CASE WHEN pos // 20 < (total - 1) // 20 THEN CAST(pos // 20 + 1 AS VARCHAR) END) AS next_page_token
FROM r GROUP BY 1, 2""")

sql("P02_revisions", ["files", "revisions"], NORM + """
SELECT r.file_id, CAST(r.revision_no AS VARCHAR) AS id, g.name AS file_name, r.keep_forever,
  CASE WHEN has_published THEN published ELSE false END AS published, false AS publish_auto,
  CASE r.size_state WHEN 'null' THEN 0 WHEN 'bad' THEN 0 WHEN 'text' THEN r.size_value END AS size_bytes,
  CASE r.user_state WHEN 'value' THEN 'Unknown' END AS user_name, CASE r.user_state WHEN 'value' THEN r.user_email END AS user_email,
  strftime(r.l_shipdate, '%Y-%m-%dT00:00:00Z') AS modified_at, CASE WHEN r.has_links THEN 2 ELSE 0 END AS links,
  CASE WHEN r.has_links THEN 'https://x.example/pdf' END AS pdf_link, r.l_partkey AS part
FROM revisions r JOIN good g ON g.id = r.file_id WHERE r.user_state <> 'null'""")

sql("N06_last_revisions", ["revisions"], """
SELECT file_id, revision_no, l_partkey, l_suppkey, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY l_shipdate DESC, revision_no DESC, l_partkey, l_suppkey, l_extendedprice) AS rank FROM revisions)
WHERE rank <= 3""")

sql("P03_permissions", ["permissions"], """
SELECT file_id, permission_id AS id, coalesce(kind, '') AS permission_type, role, coalesce(display_name, '') AS display_name,
  CASE WHEN kind IN ('user', 'group') THEN email END AS email_address, CASE WHEN kind = 'domain' THEN 'example.com' END AS domain,
  discoverable AS allow_file_discovery, deleted, false AS pending_owner, CASE WHEN expires THEN '2025-01-01T00:00:00Z' END AS expiration_time,
  CASE WHEN detail_kind = 1 THEN 'file/writer/false;member/reader/true' END AS permission_details,
  CASE WHEN detail_kind = 3 THEN 'member/organizer/false' END AS team_drive_permission_details,
  CASE WHEN detail_kind = 2 THEN 'permissionDetails is null' END AS bad_row_reason
FROM permissions""")

sql("Q05_permissions", ["files", "permissions"], NORM + """
SELECT p.file_id, p.permission_id AS id, g.name AS file_name, coalesce(kind, '') AS permission_type, role
FROM permissions p JOIN good g ON g.id = p.file_id WHERE detail_kind <> 2""")

sql("Q08_revision", ["files", "revisions"], NORM + """
SELECT w.file_id, w.id, r.keep_forever, r.file_id IS NOT NULL AS found
FROM (SELECT DISTINCT id AS file_id, unnest(['1', '2']) AS id FROM good) w
LEFT JOIN (SELECT * FROM revisions WHERE user_state <> 'null') r ON r.file_id = w.file_id AND CAST(r.revision_no AS VARCHAR) = w.id""")

sql("Q04_folder", ["files"], NORM + """
SELECT w.id, g.name, g.id IS NOT NULL AS found FROM (SELECT DISTINCT parents AS id FROM good WHERE parents <> '') w
LEFT JOIN good g ON g.id = w.id AND g.is_folder""")

sql("Q05_permission_counts", ["files", "permissions"], NORM + """
SELECT p.file_id, count(*) AS permissions, count(*) FILTER (WHERE role IN ('owner', 'writer')) AS editors,
  count(*) FILTER (WHERE kind = 'anyone') AS public_links
FROM permissions p JOIN good g ON g.id = p.file_id WHERE detail_kind <> 2 GROUP BY 1""")

sql("S06_embedded_permissions", ["files"], """
SELECT id AS file_id, 'ep' || i AS id, 'user' AS permission_type, CASE WHEN i = 0 THEN 'owner' ELSE 'reader' END AS role, '' AS display_name
FROM (SELECT id, unnest(range(CAST(permission_rows AS BIGINT))) AS i FROM files WHERE permission_rows > 0)""")

sql("P04_comments", ["comments"], """, h AS (SELECT * FROM comments WHERE turn = 0)
, r AS (SELECT comment_id, count(*) AS n, string_agg(concat_ws('/', 'r' || turn, md5(content), CAST(deleted AS VARCHAR), author, replace(created_raw, '+00:00', 'Z')), ';' ORDER BY turn) AS replies
  FROM comments WHERE turn > 0 GROUP BY 1)
SELECT h.comment_id AS id, h.file_id, md5(h.content) AS content_md5, h.resolved, false AS deleted, 'Unknown' AS author_name,
  h.author || '@example.com' AS author_email, replace(h.created_raw, '+00:00', 'Z') AS created_at, r.replies, r.n AS reply_count
FROM h LEFT JOIN r USING (comment_id)""")

sql("A12_reply_counts", ["comments"], """
SELECT comment_id, count(*) FILTER (WHERE turn > 0) AS reply_count, CAST(sum(CASE WHEN turn > 0 THEN length(content) ELSE 0 END) AS BIGINT) AS reply_chars,
  arg_max(author, turn) FILTER (WHERE turn > 0) AS last_reply_author FROM comments GROUP BY 1""")

sql("A12_assembled_replies", ["comments"], """
SELECT comment_id, (turn - 1) // 3 AS chunk, string_agg(author || ':' || md5(content), ';' ORDER BY turn) AS replies,
  CAST(sum(count(*)) OVER (PARTITION BY comment_id) AS BIGINT) AS reply_count
FROM comments WHERE turn > 0 GROUP BY 1, 2""")

sql("P15_reply_rows", ["comments"], """
SELECT comment_id, turn - 1 AS reply_no, author, md5(content) AS content_md5 FROM comments WHERE turn > 0""")

sql("S02_change_feed", ["changes"], """
SELECT connection_id, page_no, row_number() OVER (PARTITION BY connection_id, page_no ORDER BY seq) - 1 AS seq, file_id, removed,
  coalesce(raw_change_type, 'file') AS change_type, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS time,
  CASE WHEN file_state = 'file' THEN file_id END AS embedded_id, 'p/' || (page_no + 1) AS next_page_token, 's/' || page_no AS new_start_page_token
FROM changes""")

sql("S03_start_cursors", ["changes"], """
SELECT connection_id, max(page_no) + 1 AS start_cursor FROM changes GROUP BY 1""")

sql("S03_start_tokens", ["connections"], """
SELECT connection_id, CASE WHEN ok THEN CAST(c_custkey AS VARCHAR) END AS start_token, CASE WHEN NOT ok THEN 'terminal' END AS error_type,
  CASE WHEN NOT ok THEN 'TERMINALERROR' END AS error_code, CASE WHEN NOT ok THEN 'permanent' END AS error_category,
  CASE WHEN NOT ok THEN 'the API gave no start token' END AS error_message
FROM (SELECT *, c_custkey % 13 <> 0 AND c_custkey % 17 <> 0 AND c_custkey % 19 <> 0 AS ok FROM connections)""")

sql("N05_cursors", ["changes"], """
SELECT connection_id, 'drive_page_token' AS key, arg_max('s/' || seq, seq) AS value, max(page_no) AS last_page FROM changes GROUP BY 1""")

CURSORS = """, cur AS (
  SELECT connection_id, TRY_CAST(nullif(value, '') AS BIGINT) AS cursor FROM (
    SELECT *, row_number() OVER (PARTITION BY connection_id ORDER BY updated_at DESC, seq DESC) AS rn FROM state WHERE key = 'drive_page_token')
  WHERE rn = 1 AND value <> '')
, st AS (SELECT connection_id, max(page_no) + 1 AS start_cursor FROM changes GROUP BY 1)
"""
sql("Q09_changes", ["changes", "state"], CURSORS + """
SELECT c.connection_id, page_no, seq, file_id, coalesce(raw_change_type, 'file') AS change_type, shared_drive
FROM changes c JOIN st USING (connection_id) LEFT JOIN cur USING (connection_id) WHERE page_no >= coalesce(cursor, start_cursor) AND NOT removed AND NOT shared_drive""")

WEBHOOK = """, wh AS (
  SELECT w.*,
    CASE WHEN concat_ws(', ', CASE WHEN no_customer THEN 'customer_id' END) <> '' THEN 'absent in notification: customer_id'
         WHEN payload_is_text THEN 'payload is no object'
         WHEN NOT has_channel THEN 'payload names no channel'
         WHEN kind <> 'drive#stop' AND NOT has_uri THEN 'payload names no resource' END AS error,
    CASE WHEN payload_is_text THEN NULL ELSE email END AS mail,
    message_connection_id IN ('unknown', 'pending_lookup') AS lookup,
    CASE WHEN payload_is_text OR NOT has_uri OR tokenless THEN NULL ELSE 'p/' || page_no END AS token
  FROM webhooks w
), res AS (
  SELECT wh.*, CASE WHEN lookup THEN e.connection_id ELSE message_connection_id END AS connection_id,
    CASE WHEN lookup THEN e.customer_id WHEN no_customer THEN NULL ELSE 'cust_message' END AS customer_id,
    coalesce(CASE WHEN lookup THEN e.snowball_id END, CASE WHEN NOT lookup THEN k.snowball_id END) AS snowball_id,
    CASE WHEN lookup THEN e.sync_files ELSE k.sync_files END AS sync_files, CASE WHEN lookup THEN e.sync_folders ELSE k.sync_folders END AS sync_folders,
    CASE WHEN lookup AND mail IS NULL THEN 'EXTERNAL_ID_EXTRACTION_FAILED' WHEN lookup AND e.connection_id IS NULL THEN 'CONNECTION_NOT_FOUND' END AS resolution_error
  FROM wh LEFT JOIN connections e ON lookup AND e.external_id = wh.mail LEFT JOIN connections k ON k.connection_id = wh.message_connection_id
), outc AS (
  SELECT *, CASE WHEN error IS NOT NULL THEN 'invalid' WHEN resolution_error IS NOT NULL THEN 'unresolved' WHEN kind = 'drive#stop' THEN 'stop'
    WHEN token IS NULL THEN 'no_token' ELSE 'fetch' END AS outcome FROM res
)
"""
sql("X15_webhook_outcomes", ["webhooks", "connections"], WEBHOOK + """
SELECT message_id, outcome, error, resolution_error, token AS page_token, mail AS email, message_connection_id,
  CASE WHEN error IS NULL THEN connection_id END AS connection_id, CASE WHEN error IS NULL THEN customer_id END AS customer_id FROM outc""")

sql("T11_resolution_as_of", ["webhooks", "connections", "connection_versions"], WEBHOOK + """, ver AS (
  SELECT *, coalesce(valid_from, TIMESTAMP '1000-01-01') AS since FROM connection_versions
), claim AS (
  SELECT w.seq, v.connection_id AS claimed FROM wh w JOIN ver v ON w.lookup AND v.active AND v.external_id = w.mail AND v.since <= w.ts
  QUALIFY row_number() OVER (PARTITION BY w.seq ORDER BY v.since DESC, v.version_seq DESC) = 1
), asked AS (
  SELECT w.*, CASE WHEN lookup THEN claimed ELSE message_connection_id END AS target FROM wh w LEFT JOIN claim USING (seq) WHERE error IS NULL
), then_valid AS (
  SELECT a.seq, v.* FROM asked a JOIN ver v ON v.connection_id = a.target AND v.since <= a.ts
  QUALIFY row_number() OVER (PARTITION BY a.seq ORDER BY v.since DESC, v.version_seq DESC) = 1
)
SELECT a.seq, message_id, message_connection_id, mail AS email,
  CASE WHEN lookup THEN v.connection_id ELSE message_connection_id END AS connection_id,
  CASE WHEN lookup THEN v.customer_id WHEN no_customer THEN NULL ELSE 'cust_message' END AS customer_id,
  v.snowball_id, v.sync_files, v.version_seq,
  CASE WHEN lookup AND mail IS NULL THEN 'EXTERNAL_ID_EXTRACTION_FAILED' WHEN lookup AND v.seq IS NULL THEN 'CONNECTION_NOT_FOUND' END AS resolution_error
FROM asked a LEFT JOIN then_valid v ON v.seq = a.seq AND v.active AND (NOT a.lookup OR v.external_id = a.mail)""")

PAGES = """, req AS (
  SELECT connection_id, token, count(*) AS notifications, arg_min(message_id, seq) AS message_id, arg_min(customer_id, seq) AS customer_id,
    any_value(snowball_id) AS snowball_id, any_value(sync_files) AS sync_files, any_value(sync_folders) AS sync_folders
  FROM outc WHERE outcome = 'fetch' GROUP BY 1, 2
), pages AS (
  SELECT c.seq, c.connection_id, c.file_id, c.removed, c.raw_change_type, c.file_state, q.* EXCLUDE (connection_id), n.bad, n.type, n.is_folder,
    (NOT c.removed AND c.file_state = 'file' AND n.bad IS NULL AND q.snowball_id IS NOT NULL
      AND CASE WHEN n.is_folder THEN coalesce(q.sync_folders, true) ELSE coalesce(q.sync_files, true) END) AS yielded
  FROM changes c JOIN req q ON q.connection_id = c.connection_id AND q.token = 'p/' || c.page_no JOIN norm n ON n.doc_id = c.doc_id
)
"""
REAL = """, realtime AS (
  SELECT *, row_number() OVER (PARTITION BY connection_id, token ORDER BY seq) - 1 AS pos, 'drive:' || connection_id || ':' || type || ':' || file_id AS nonce
  FROM pages WHERE yielded)
"""
sql("Q13_webhook_changes", ["webhooks", "connections", "changes", "files"], NORM + WEBHOOK + PAGES + REAL + """
SELECT connection_id, seq, nonce, pos AS batch_sequence, false AS batch_is_last, token AS page_token, customer_id,
  '/' || customer_id || '/graph/snowball/' || snowball_id AS space_path, 'webhook' AS source, coalesce(raw_change_type, 'file') AS change_type,
  sha256(message_id || '|' || token || '|' || seq) AS batch_id FROM realtime""")

sql("A03_change_summary", ["webhooks", "connections", "changes", "files"], NORM + WEBHOOK + PAGES + """
SELECT connection_id, token AS page_token, notifications, count(*) AS total_changes, count(*) FILTER (WHERE yielded) AS total_yielded,
  count(*) - count(*) FILTER (WHERE yielded) AS skipped FROM pages GROUP BY 1, 2, 3""")

SYNC_OUT = """connection_id AS integration_connection_id, customer_id, light_type AS resource_type, id AS resource_id,
  'drive:' || connection_id || ':' || light_type || ':' || id AS idempotency_key, light_name AS name, light_size AS size_bytes,
  light_owner_email AS owner_email"""
HAS_EXPORT = "coalesce(light_mime IN ('application/vnd.google-apps.document', 'application/vnd.google-apps.spreadsheet'), false)"

sql("Q11_full_sync", ["files", "connections"], LIGHT + f""", rows AS (
  SELECT l.*, {HAS_EXPORT} AS has_export FROM light l JOIN connections c USING (connection_id)
  WHERE light_bad IS NULL AND coalesce(light_trashed, false) = false
    AND CASE WHEN light_type = 'folder' THEN coalesce(c.sync_folders, true) ELSE coalesce(c.sync_files, true) END
    AND (doc_id % 6 <> 1 OR coalesce(c.sync_shared_drives, true)))
SELECT {SYNC_OUT.replace('customer_id', 'customer_id', 1)}, 'full_sync' AS trigger_type, CAST(NULL AS VARCHAR) AS change_type, has_export AS has_content,
  CASE WHEN has_export THEN octet_length(encode(text)) ELSE 0 END AS content_size_bytes FROM rows""")

sql("Q12_incremental", ["files", "connections", "changes", "state"], LIGHT + CURSORS + f""", rows AS (
  SELECT l.* EXCLUDE (connection_id, customer_id), ch.connection_id, c.customer_id, ch.page_no, ch.seq, coalesce(raw_change_type, 'file') AS change_type,
    {HAS_EXPORT} AS has_export
  FROM changes ch JOIN light l ON l.doc_id = ch.doc_id LEFT JOIN cur ON cur.connection_id = ch.connection_id JOIN st ON st.connection_id = ch.connection_id
  LEFT JOIN connections c ON c.connection_id = ch.connection_id
  WHERE ch.page_no >= coalesce(cur.cursor, st.start_cursor) AND NOT ch.removed AND ch.file_state = 'file' AND light_bad IS NULL
    AND CASE WHEN light_type = 'folder' THEN coalesce(c.sync_folders, true) ELSE coalesce(c.sync_files, true) END
    AND (NOT ch.shared_drive OR coalesce(c.sync_shared_drives, true)))
SELECT page_no, seq, {SYNC_OUT}, 'incremental' AS trigger_type, change_type, has_export AS has_content,
  CASE WHEN has_export THEN octet_length(encode(text)) ELSE 0 END AS content_size_bytes FROM rows""")

sql("A04_sync_progress", ["changes"], """, p AS (SELECT connection_id, page_no, count(*) AS page_changes FROM changes GROUP BY 1, 2)
SELECT connection_id, page_no, page_changes, CAST(sum(page_changes) OVER w AS BIGINT) AS changes_processed,
  sum(page_changes) OVER w < sum(page_changes) OVER (PARTITION BY connection_id) AS has_more
FROM p WINDOW w AS (PARTITION BY connection_id ORDER BY page_no)""")

LATEST = """, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY page_no DESC, seq DESC) AS rn FROM changes) WHERE rn = 1)
"""
sql("N08_latest_change", ["changes"], LATEST + """
SELECT file_id, seq, page_no, removed, coalesce(raw_change_type, 'file') AS change_type, connection_id FROM latest""")
sql("J09_live_files", ["files", "changes"], NORM + LATEST + """
SELECT id, name, category FROM good WHERE id NOT IN (SELECT file_id FROM latest WHERE removed)""")
sql("J09_tombstones", ["changes"], LATEST + "SELECT file_id, true AS deleted FROM latest WHERE removed")

MSG = """, m AS (
  SELECT *, CASE connection_state WHEN 'value' THEN connection_id WHEN 'blank' THEN '' END AS conn_raw,
    CASE WHEN seq % 31 <> 0 THEN provider END AS rpc_provider,
    CASE WHEN wrong_action THEN 'unknown' ELSE verb END AS called,
    CASE WHEN connection_state = 'value' THEN connection_id WHEN connection_state = 'blank' THEN CASE WHEN as_jsonrpc THEN 'unknown' ELSE '' END ELSE 'unknown' END AS conn_out
  FROM commands)
, m2 AS (
  SELECT *, CASE WHEN as_jsonrpc THEN nullif(rpc_provider, '') ELSE provider END AS provider_out,
    CASE WHEN as_jsonrpc THEN
      CASE WHEN called <> 'fetch' THEN 'method' WHEN NOT has_customer THEN 'customer_id' WHEN connection_state <> 'value' THEN 'integration_connection_id'
           WHEN coalesce(resource_type, 'files') = 'playlists' THEN 'resource_type' END
      ELSE CASE WHEN NOT has_customer THEN 'customer_id' WHEN connection_state = 'absent' THEN 'integration_connection_id'
           WHEN called <> 'fetch' THEN 'action' WHEN resource_type = 'playlists' THEN 'resource_type' END END AS fetch_error,
    CASE WHEN as_jsonrpc THEN
      CASE WHEN called <> 'write' THEN 'method' WHEN connection_state <> 'value' THEN 'integration_connection_id'
           WHEN operation IS NULL OR operation = 'explode_file' THEN 'operation' END
      ELSE CASE WHEN NOT has_customer THEN 'customer_id' WHEN connection_state = 'absent' THEN 'integration_connection_id' WHEN operation IS NULL THEN 'operation'
           WHEN seq % 43 = 0 THEN 'payload' WHEN called <> 'write' THEN 'action' WHEN operation = 'explode_file' THEN 'operation' END END AS write_error,
    CASE WHEN as_jsonrpc THEN CASE WHEN called <> 'init' THEN 'method' WHEN connection_state <> 'value' THEN 'integration_connection_id' END
      ELSE CASE WHEN NOT has_customer THEN 'customer_id' WHEN connection_state = 'absent' THEN 'integration_connection_id' WHEN called <> 'init' THEN 'action' END END AS init_error,
    CASE WHEN as_jsonrpc THEN CASE WHEN called <> 'teardown' THEN 'method' WHEN connection_state <> 'value' THEN 'integration_connection_id' END
      ELSE CASE WHEN NOT has_customer THEN 'customer_id' WHEN connection_state = 'absent' THEN 'integration_connection_id' WHEN called <> 'teardown' THEN 'action' END END AS teardown_error
  FROM m)
, m3 AS (
  SELECT *, CASE WHEN nullif(provider_out, '') <> 'drive' THEN 'skipped'
      WHEN as_jsonrpc THEN CASE called WHEN 'other' THEN 'capability' WHEN 'unknown' THEN NULL ELSE called END
      ELSE CASE WHEN provider = 'drive' AND called IN ('init', 'fetch', 'write', 'teardown', 'webhook') THEN called END END AS route
  FROM m2)
, m4 AS (SELECT *, CASE route WHEN 'fetch' THEN fetch_error WHEN 'write' THEN write_error WHEN 'init' THEN init_error WHEN 'teardown' THEN teardown_error END AS error_field FROM m3)
"""
sql("X13_validate_fetch", ["commands"], MSG + """
SELECT message_id, fetch_error AS error_field, coalesce(resource_type, 'files') AS resource_type,
  CASE WHEN NOT as_jsonrpc OR max_results IS NULL THEN 100 ELSE least(greatest(max_results, 1), 1000) END AS page_size FROM m4""")
sql("X14_validate_trigger", ["commands"], MSG + """
SELECT message_id_out AS message_id, CASE WHEN missing <> '' THEN 'absent: ' || missing
  WHEN trigger_type NOT IN ('full_sync', 'incremental', 'poll') THEN 'unknown trigger ' || trigger_type || ' (known: full_sync, incremental, poll)' END AS error
FROM (SELECT message_id AS message_id_out, concat_ws(', ', CASE WHEN as_jsonrpc THEN 'message_id' END, CASE WHEN as_jsonrpc OR NOT has_customer THEN 'customer_id' END,
  CASE WHEN as_jsonrpc THEN 'integration_id' END, CASE WHEN as_jsonrpc OR connection_state = 'absent' THEN 'integration_connection_id' END,
  CASE WHEN as_jsonrpc OR trigger_type IS NULL THEN 'trigger_type' END) AS missing, trigger_type FROM m4)""")
sql("X16_validate_write", ["commands"], MSG + "SELECT message_id, write_error AS error_field FROM m4")
sql("X17_validate_lifecycle", ["commands"], MSG + "SELECT message_id, init_error, teardown_error FROM m4")
sql("T01_routes", ["commands"], MSG + """
SELECT message_id, route, conn_out AS connection_id, provider_out AS provider, error_field FROM m4""")
sql("A01_worker_counters", ["commands"], MSG + """, o AS (
  SELECT seq, coalesce(route, 'none') AS route, CASE WHEN route IS NULL OR route = 'skipped' THEN 'skipped' WHEN error_field IS NOT NULL THEN 'terminal' ELSE 'ok' END AS outcome FROM m4)
SELECT route, count(*) FILTER (WHERE outcome = 'ok') AS messages_processed, count(*) FILTER (WHERE outcome = 'terminal') AS messages_failed,
  count(*) FILTER (WHERE outcome = 'skipped') AS messages_skipped, count(*) FILTER (WHERE outcome = 'ok') AS records_produced,
  count(*) FILTER (WHERE outcome = 'terminal') AS errors_produced, 0 AS errors_retriable, count(*) FILTER (WHERE outcome = 'terminal') AS errors_terminal,
  0 AS duplicates_skipped, count(*) FILTER (WHERE seq % 10 = 0) AS payloads_offloaded, CAST(sum(seq % 1000) AS BIGINT) AS processing_ms FROM o GROUP BY 1""")
sql("J01_connection_enrich", ["commands", "connections"], MSG + """
SELECT m.message_id, conn_out AS connection_id,
  coalesce(CASE WHEN as_jsonrpc THEN nullif(msg_snowball_id, '') END, c.snowball_id) AS snowball_id,
  coalesce(CASE WHEN as_jsonrpc THEN msg_external_id END, c.external_id) AS external_id,
  coalesce(CASE WHEN as_jsonrpc THEN msg_external_id END, c.external_id) AS user_id,
  coalesce(c.customer_id, CASE WHEN has_customer THEN m.customer_id END) AS customer_id,
  coalesce(CASE WHEN as_jsonrpc THEN nullif(msg_token, '') END, 'stored-' || c.connection_id) AS access_token
FROM m4 m LEFT JOIN connections c ON c.connection_id = m.conn_out""")
sql("K02_validation_errors", ["commands"], MSG + """
SELECT message_id AS source_message_id, conn_out AS connection_id, CASE WHEN has_customer THEN customer_id ELSE 'unknown' END AS customer_id,
  'terminal' AS error_type, 'VALIDATIONERROR' AS error_code, 'validation' AS error_category, '{"field":"' || error_field || '"}' AS details
FROM m4 WHERE error_field IS NOT NULL""")

sql("K02_api_errors", ["calls"], """
SELECT event_id, connection_id, CASE WHEN status_code IS NULL OR status_code IN (429, 503) THEN 'retriable' ELSE 'terminal' END AS error_type,
  CASE status_code WHEN 429 THEN 'RATELIMITERROR' WHEN 503 THEN 'RETRIABLEERROR' WHEN 401 THEN 'AUTHENTICATIONERROR' WHEN 404 THEN 'TERMINALERROR' ELSE 'RETRIABLEERROR' END AS error_code,
  CASE status_code WHEN 429 THEN 'rate_limit' WHEN 503 THEN 'transient' WHEN 401 THEN 'authentication' WHEN 404 THEN 'permanent' ELSE 'transient' END AS error_category,
  CASE status_code WHEN 429 THEN 'throttled by the API' WHEN 503 THEN 'server failure, status 503' WHEN 401 THEN 'credentials refused, status 401'
    WHEN 404 THEN 'request refused, status 404 - ' || CASE event_id % 3 WHEN 0 THEN 'File not found' WHEN 1 THEN 'gone' ELSE 'plain failure text' END
    ELSE 'no answer from the API' END AS error_message,
  CASE status_code WHEN 503 THEN '{"status_code":503}' END AS details,
  CASE WHEN status_code = 429 THEN CASE event_id % 3 WHEN 0 THEN 30 ELSE 60 END END AS retry_after
FROM calls WHERE status_code IS NULL OR status_code <> 200""")

NONCE = """, nr AS (SELECT seq, connection_id, CASE WHEN seq % 37 = 0 THEN '' ELSE 'drive:' || connection_id || ':file:' || file_id END AS nonce FROM changes)
"""
sql("N07_dedup", ["changes"], NONCE + "SELECT nonce, min(seq) AS seq FROM nr WHERE nonce <> '' GROUP BY 1")
sql("U03_dedup_blank", ["changes"], NONCE + """
SELECT nonce, min(seq) AS seq FROM nr WHERE nonce <> '' GROUP BY 1 UNION ALL SELECT nonce, seq FROM nr WHERE nonce = ''""")
sql("A13_dedup_stats", ["changes"], NONCE + """
SELECT connection_id, count(*) AS records, count(DISTINCT nullif(nonce, '')) AS distinct_nonces,
  count(nullif(nonce, '')) - count(DISTINCT nullif(nonce, '')) AS duplicates,
  round((count(nullif(nonce, '')) - count(DISTINCT nullif(nonce, ''))) / count(*)::DOUBLE, 6) AS hit_rate FROM nr GROUP BY 1""")
TTL = f""", acc AS (
  SELECT file_id, min(ts) AS ts FROM changes GROUP BY 1
  UNION ALL
  SELECT file_id, nxt FROM (SELECT a.file_id, (SELECT min(c.ts) FROM changes c WHERE c.file_id = a.file_id AND c.ts >= a.ts + INTERVAL {TTL_SECONDS} SECOND) AS nxt FROM acc a)
  WHERE nxt IS NOT NULL)
SELECT acc.file_id, min(c.seq) AS seq, epoch_us(acc.ts) AS at_us FROM acc JOIN changes c ON c.file_id = acc.file_id AND c.ts = acc.ts GROUP BY acc.file_id, acc.ts"""
sql("T02_ttl_dedup", ["changes"], TTL)
sql("stream_ttl_dedup", ["changes"], TTL)
sql("T02_page_requests", ["webhooks", "connections"], WEBHOOK + f""", ask AS (SELECT * FROM outc WHERE outcome = 'fetch'), acc AS (
  SELECT connection_id, token, min(ts) AS ts FROM ask GROUP BY 1, 2
  UNION ALL
  SELECT connection_id, token, nxt FROM (SELECT a.connection_id, a.token, (SELECT min(c.ts) FROM ask c WHERE c.connection_id = a.connection_id
    AND c.token = a.token AND c.ts >= a.ts + INTERVAL {PAGE_TTL_SECONDS} SECOND) AS nxt FROM acc a)
  WHERE nxt IS NOT NULL
), span AS (
  SELECT *, lead(ts) OVER (PARTITION BY connection_id, token ORDER BY ts) AS until FROM acc)
SELECT s.connection_id, s.token AS page_token, count(*) AS notifications, epoch_us(s.ts) AS at_us, min(a.seq) FILTER (WHERE a.ts = s.ts) AS request_seq,
  arg_min(a.message_id, a.seq) FILTER (WHERE a.ts = s.ts) AS message_id, arg_min(a.customer_id, a.seq) FILTER (WHERE a.ts = s.ts) AS customer_id,
  arg_min(a.snowball_id, a.seq) FILTER (WHERE a.ts = s.ts) AS snowball_id
FROM span s JOIN ask a ON a.connection_id = s.connection_id AND a.token = s.token AND a.ts >= s.ts AND (s.until IS NULL OR a.ts < s.until)
GROUP BY s.connection_id, s.token, s.ts""")

REFS = """, refs AS (SELECT customer_id, connection_id, id AS file_id, sha256(text) AS sha256, octet_length(encode(text)) AS size_bytes, text FROM files)
, paths AS (SELECT *, concat_ws('/', substr(customer_id, 1, 2), substr(customer_id, 3, 2), customer_id, substr(sha256, 1, 2), substr(sha256, 3, 2), sha256) AS storage_path FROM refs)
"""
sql("K03_blob_index", ["files"], REFS + """
SELECT customer_id, sha256, min(storage_path) AS storage_path, max(size_bytes) AS size_bytes, min(file_id) AS first_file_id, count(*) AS ref_count
FROM paths GROUP BY 1, 2""")
sql("K03_blob_runs", ["files"], REFS + """
SELECT customer_id, sha256, min(storage_path) AS storage_path, max(size_bytes) AS size_bytes, min(file_id) AS first_file_id, count(*) AS ref_count, 1 AS copies
FROM paths GROUP BY 1, 2""")
sql("A14_blob_savings", ["files"], REFS + """, b AS (SELECT customer_id, sha256, max(size_bytes) AS s, count(*) AS n FROM refs GROUP BY 1, 2)
SELECT customer_id, CAST(sum(n) AS BIGINT) AS files, count(*) AS blobs, CAST(sum(s * n) AS BIGINT) AS bytes_before, CAST(sum(s) AS BIGINT) AS bytes_after,
  CAST(sum(s * n) - sum(s) AS BIGINT) AS bytes_saved FROM b GROUP BY 1""")
sql("J07_file_content", ["files"], NORM + ELIGIBLE + REFS + """
SELECT e.id AS file_id, e.reason IS NULL AS has_content, CASE WHEN e.reason IS NULL THEN p.sha256 END AS sha256,
  CASE WHEN e.reason IS NULL THEN p.storage_path END AS storage_path, CASE WHEN e.reason IS NULL THEN p.size_bytes END AS size_bytes
FROM elig e JOIN paths p ON p.file_id = e.id""")
sql("K04_offloaded_payloads", ["files"], REFS + f"""
SELECT 's3://bucket/payloads/' || customer_id || '/' || connection_id || '/' || file_id || '.json' AS storage_path, md5(text) AS content_md5
FROM refs WHERE size_bytes > {OFFLOAD_BYTES}""")
sql("K04_offload_split", ["files"], REFS + f"""
SELECT file_id AS message_id, CASE WHEN size_bytes <= {OFFLOAD_BYTES} THEN md5(text) END AS data_md5,
  CASE WHEN size_bytes > {OFFLOAD_BYTES} THEN 's3://bucket/payloads/' || customer_id || '/' || connection_id || '/' || file_id || '.json' END AS s3_url,
  CASE WHEN size_bytes > {OFFLOAD_BYTES} THEN sha256 END AS sha256, size_bytes AS payload_size_bytes, size_bytes > {OFFLOAD_BYTES} AS offloaded FROM refs""")
JSON_OWNER = """concat('{', concat_ws(',', '"name":' || to_json(owner1), '"email":' || to_json(owner_email),
  CASE WHEN owner_key % 2 = 0 THEN '"photo_link":"https://img.example/p"' END), '}')"""
sql("K01_outbound_records", ["files", "connections"], NORM + READY + TEXT.replace("FROM good)", "FROM ranked)") + f""", env AS (
  SELECT *, 'drive:' || connection_id || ':' || type || ':' || id AS nonce, sha256('fetch|' || connection_id || '|' || (pos // 100)) AS batch_id FROM texts)
, rec AS (
  SELECT *, concat('{{"id":"', sha256(batch_id || '|' || id), '","jsonrpc":"2.0","method":"metadata.integration.content.ingest","params":{{"header":',
    '{{"to_addresses":[{{"topics":["integrations-incoming-records"],"topic_key":"', connection_id, '"}}],"return_addresses":[],"message_call_stack":[],"parameters":{{',
    concat_ws(',', '"customer_id":"' || customer_id || '"', '"integration_provider_name":"drive"', '"integration_connection_id":"' || connection_id || '"',
      '"space_path":"/' || customer_id || '/graph/snowball/' || snowball_id || '"', '"correlation_id":"' || nonce || '"', '"energy":5', '"batch_id":"' || batch_id || '"',
      '"batch_sequence":' || (pos % 100), '"batch_is_last":' || (pos = total - 1),
      CASE WHEN pos // 100 < (total - 1) // 100 THEN '"batch_page_token":"' || (pos // 100 + 1) || '"' END),
    '}}}},"contents":[{{"type":"text","text":', to_json(text_out), '}}],"metadata":{{',
    concat_ws(',', '"resource_type":"' || type || '"', '"resource_id":"' || id || '"', '"drive_id":"' || id || '"', '"name":' || to_json(name), '"mime_type":"' || mime_type || '"',
      '"category":"' || category || '"', '"is_folder":' || is_folder, '"is_google_workspace":' || is_native, '"trashed":' || trashed, '"starred":' || starred,
      '"source_document_url":"' || link || '"', '"source_document_title":' || to_json(coalesce(nullif(name, ''), '(Untitled)')), '"export_format":"' || export_format || '"',
      '"size_bytes":' || size_bytes, '"web_view_link":"' || link || '"', CASE WHEN has_thumbnail THEN '"thumbnail_link":"https://img.example/' || id || '"' END,
      CASE WHEN parents <> '' THEN '"parent_ids":["' || parents || '"]' END,
      CASE owners_state WHEN 'one' THEN '"owners":[' || {JSON_OWNER} || ']' WHEN 'two' THEN '"owners":[' || {JSON_OWNER} || ',{{"name":"Second Owner","email":"' || second_email || '"}}]' END,
      '"shared":' || shared, '"created_at":"' || created_at || '"', '"modified_at":"' || modified_at || '"', '"has_content":false'),
    '}},"nonce":"', nonce, '"}}}}') AS value, doc_id % 19 = 0 OR doc_id % 23 = 0 AS rejected FROM env)
SELECT connection_id AS key, md5(value) AS value_md5, octet_length(encode(value)) AS record_bytes, octet_length(encode(value)) > {RECORD_BYTES} AS offloaded,
  CASE WHEN rejected THEN 'terminal' ELSE 'record' END AS output, CASE WHEN NOT rejected THEN 'drive-worker' END AS source, CASE WHEN NOT rejected THEN nonce END AS nonce
FROM rec""")
sql("U01_union_paths", ["webhooks", "connections", "changes", "files"], NORM + WEBHOOK + PAGES + REAL + READY + """
, back AS (SELECT connection_id, 'drive:' || connection_id || ':' || type || ':' || id AS nonce FROM ready)
SELECT connection_id, 'backfill' AS path, count(DISTINCT nonce) AS records FROM back GROUP BY 1
UNION ALL SELECT connection_id, 'webhook', count(DISTINCT nonce) FROM realtime WHERE nonce NOT IN (SELECT nonce FROM back) GROUP BY 1""")

sql("A07_api_errors", ["calls"], """
SELECT endpoint, status_code, count(*) AS calls, count(*) FILTER (WHERE status_code IS NULL OR status_code >= 400) AS errors FROM calls GROUP BY 1, 2""")
sql("A08_latency", ["calls"], """
SELECT endpoint, count(*) AS calls, round(quantile_cont(round(latency_ms, 2), 0.5), 6) AS p50, round(quantile_cont(round(latency_ms, 2), 0.95), 6) AS p95,
  round(quantile_cont(round(latency_ms, 2), 0.99), 6) AS p99 FROM calls GROUP BY 1""")
sql("A09_alerts", ["calls"], """
SELECT * FROM (SELECT endpoint, count(*) AS calls, count(*) FILTER (WHERE status_code IS NULL OR status_code >= 400) AS errors,
  round(count(*) FILTER (WHERE status_code IS NULL OR status_code >= 400) / count(*)::DOUBLE, 6) AS error_rate,
  count(*) FILTER (WHERE status_code IS NULL OR status_code >= 400) / count(*)::DOUBLE >= 0.01 AS error_rate_high,
  quantile_cont(round(latency_ms, 2), 0.95) >= 100 AS p95_high FROM calls GROUP BY 1) WHERE error_rate_high OR p95_high""")
sql("A10_request_cost", ["commands"], """, man(op, cost, ms) AS (VALUES ('initialize', 1, 500), ('files', 1, 300), ('folders', 1, 300), ('changes', 1, 300), ('revisions', 1, 250),
  ('create_file', 5, 500), ('delete_file', 2, 300), ('move_file', 2, 300), ('create_permission', 3, 400), ('update_file', 5, 400))
, r AS (SELECT connection_id, CASE WHEN verb = 'init' THEN 'initialize' WHEN verb = 'fetch' THEN coalesce(resource_type, 'files')
  ELSE CASE operation WHEN 'upload_file' THEN 'create_file' WHEN 'share_file' THEN 'create_permission' WHEN 'update_metadata' THEN 'update_file' ELSE operation END END AS op FROM commands)
SELECT connection_id, count(*) AS requests, count(*) FILTER (WHERE cost IS NULL) AS unknown_requests, CAST(sum(coalesce(cost, 0)) AS BIGINT) AS cost,
  CAST(sum(coalesce(ms, 0)) AS BIGINT) AS estimated_ms FROM r LEFT JOIN man USING (op) GROUP BY 1""")
sql("N09_failure_streaks", ["calls"], """, s AS (
  SELECT *, (status_code IS NULL OR status_code <> 200) AS failed,
    sum(CASE WHEN status_code = 200 THEN 1 ELSE 0 END) OVER (PARTITION BY endpoint ORDER BY ts, event_id) AS grp FROM calls)
SELECT endpoint, count(*) AS failures, epoch_us(min(ts)) AS started_us, epoch_us(max(ts)) AS ended_us FROM s WHERE failed GROUP BY endpoint, grp HAVING count(*) >= 5""")
QUOTA = """, w AS (SELECT connection_id, (epoch_us(ts) // 100000000) * 100 AS window_start, count(*) AS calls FROM calls GROUP BY 1, 2)
"""
sql("T08_quota", ["calls"], QUOTA + "SELECT connection_id, window_start, calls, round(calls / 1.0::DOUBLE, 6) AS quota_share FROM w WHERE calls > 1")
sql("T08_project_quota", ["calls"], """, w AS (SELECT (epoch_us(ts) // 100000000) * 100 AS window_start, count(*) AS calls FROM calls GROUP BY 1)
SELECT window_start, calls, round(calls / 2.0::DOUBLE, 6) AS quota_share FROM w WHERE calls > 1.6""")
sql("A09_dead_letters", ["commands", "calls"], MSG + """, e AS (
  SELECT 'VALIDATIONERROR' AS error_code FROM m4 WHERE error_field IS NOT NULL
  UNION ALL SELECT CASE status_code WHEN 401 THEN 'AUTHENTICATIONERROR' ELSE 'TERMINALERROR' END FROM calls WHERE status_code IN (401, 404))
SELECT 'drive' AS provider, error_code, count(*) AS dead_letters FROM e GROUP BY ALL HAVING count(*) >= 5""")
sql("A09_consumer_lag", ["commands"], """, n AS (SELECT seq % 4 AS partition, max(seq // 4) AS newest, min(seq // 4) AS oldest,
  max(seq // 4) FILTER (WHERE o_orderstatus = 'F' AND seq % 4 < 2) + 1 AS committed FROM commands GROUP BY 1)
SELECT partition, newest + 1 - coalesce(committed, oldest) AS lag, newest + 1 - coalesce(committed, oldest) >= 1000 AS lag_high FROM n""")
ORACLES["T10_throughput"] = """
SELECT event_type, (epoch_us(ts) // 3600000000) * 3600 AS window_start, count(*) AS messages, round(count(*) / 3600.0::DOUBLE, 6) AS per_second, true AS above_target
FROM events GROUP BY 1, 2"""
sql("T07_retry_schedule", ["calls"], """, f AS (
  SELECT event_id, ts, event_id % 4 + 1 AS attempt, status_code IS NULL OR status_code IN (429, 503) AS retriable,
    CASE WHEN status_code = 429 THEN CASE event_id % 3 WHEN 0 THEN 30 ELSE 60 END END AS ra FROM calls WHERE status_code IS NULL OR status_code <> 200)
, g AS (SELECT *, CASE WHEN attempt >= 3 OR NOT retriable THEN NULL ELSE coalesce(ra::DOUBLE, least(2.0 * 2.0 ** (attempt - 1), 60.0)) END AS w FROM f)
SELECT event_id, attempt, w AS wait_seconds, epoch_us(ts) + CAST(w * 1000000 AS BIGINT) AS next_attempt_us,
  CASE WHEN w IS NULL THEN 'dead_letter' WHEN epoch_us(ts) + CAST(w * 1000000 AS BIGINT) <= epoch_us(TIMESTAMP '2024-01-15') THEN 'due' ELSE 'waiting' END AS disposition FROM g""")

STATE = """, cs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY connection_id, key ORDER BY updated_at DESC, seq DESC) AS rn FROM state) WHERE rn = 1)
"""
sql("K05_state_upsert", ["state"], STATE + "SELECT connection_id, key, value, seq, epoch_us(updated_at) AS updated_us FROM cs")
sql("K05_state_table", ["state", "commands"], MSG + STATE + """
SELECT connection_id, key, value, seq, epoch_us(updated_at) AS updated_us FROM cs
WHERE connection_id NOT IN (SELECT conn_out FROM m4 WHERE route = 'teardown' AND error_field IS NULL)""")
sql("K06_teardown", ["state", "commands"], MSG + STATE + """
SELECT connection_id, key, value FROM cs WHERE connection_id NOT IN (SELECT conn_out FROM m4 WHERE route = 'teardown' AND error_field IS NULL)""")
sql("T12_expired_cursors", ["state", "changes"], CURSORS + """, old AS (
  SELECT connection_id, min(page_no) AS oldest_page FROM (SELECT *, max(page_no) OVER () AS newest FROM changes) WHERE 16 * page_no >= 15 * newest GROUP BY 1)
SELECT connection_id, cursor, oldest_page, 'ChangeTokenExpiredError' AS error_class, true AS requires_backfill FROM cur JOIN old USING (connection_id) WHERE cursor < oldest_page""")
sql("T09_renewal_due", ["state"], STATE + """
SELECT connection_id, TRY_CAST(value AS BIGINT) AS expiration, TRY_CAST(value AS BIGINT) <= epoch_ms(TIMESTAMP '2024-02-01') AS already_expired
FROM cs WHERE key = 'drive_channel_expiration' AND TRY_CAST(value AS BIGINT) - 3600000 <= epoch_ms(TIMESTAMP '2024-02-01')""")
INIT = MSG + """, ini AS (
  SELECT m.seq, m.message_id, conn_out AS connection_id, coalesce(c.customer_id, CASE WHEN has_customer THEN m.customer_id END) AS customer_id,
    as_jsonrpc AND m.seq % 5 <> 0 AND has_webhook_url AS enabled, CASE WHEN c.c_custkey % 5 <> 0 THEN c.external_id END AS email, c.display_name,
    coalesce(CAST(t.tok AS VARCHAR), '0') AS tok
  FROM m4 m LEFT JOIN connections c ON c.connection_id = m.conn_out
  LEFT JOIN (SELECT connection_id, max(page_no) + 1 AS tok FROM changes GROUP BY 1) t ON t.connection_id = m.conn_out
  WHERE route = 'init' AND error_field IS NULL)
"""
sql("K08_ready_events", ["commands", "connections", "changes"], INIT + """
SELECT connection_id, customer_id, email, CASE WHEN email IS NOT NULL THEN display_name END AS display_name,
  CASE WHEN enabled THEN sha256('channel|' || message_id) END AS channel_id,
  CASE WHEN enabled THEN epoch_ms(TIMESTAMP '2024-02-01' + INTERVAL 23 HOUR) END AS channel_expiration, CASE WHEN enabled THEN tok END AS page_token, 1000 AS max_results
FROM ini""")
sql("Q14_channel_state", ["commands", "connections", "changes", "state"], INIT + """, cs AS (
  SELECT connection_id, key, value, updated_at, seq FROM state
  UNION ALL SELECT connection_id, k, v, TIMESTAMP '2024-02-01', seq FROM (
    SELECT connection_id, seq, unnest(['drive_page_token', 'drive_channel_id', 'drive_resource_id', 'drive_channel_expiration', 'drive_channel_token']) AS k,
      unnest([tok, sha256('channel|' || message_id), sha256('resource|' || message_id), CAST(epoch_ms(TIMESTAMP '2024-02-01' + INTERVAL 23 HOUR) AS VARCHAR), sha256('token|' || message_id)]) AS v
    FROM ini WHERE enabled))
SELECT connection_id, key, value, seq FROM (SELECT *, row_number() OVER (PARTITION BY connection_id, key ORDER BY updated_at DESC, seq DESC) AS rn FROM cs) WHERE rn = 1""")
sql("Q10_about", ["connections"], """
SELECT connection_id, CASE WHEN c_custkey % 5 <> 0 THEN external_id END AS email, display_name, CASE WHEN c_custkey % 3 <> 0 THEN 16106127360 END AS quota_limit,
  CAST(floor(abs(c_acctbal) * 100) AS BIGINT) AS quota_usage,
  round(CASE WHEN c_custkey % 3 <> 0 THEN CAST(floor(abs(c_acctbal) * 100) AS DOUBLE) / 16106127360 END, 6) AS quota_share FROM connections""")

CMD = """, k AS (
  SELECT *, CASE operation WHEN 'upload_file' THEN 'create_file' WHEN 'update_metadata' THEN 'update_file' WHEN 'share_file' THEN 'create_permission'
    WHEN 'unshare_file' THEN 'delete_permission' WHEN 'explode_file' THEN NULL ELSE operation END AS kind FROM writes)
, checked AS (
  SELECT *, CASE WHEN kind IS NULL THEN 'operation'
    WHEN kind IN ('create_file', 'create_folder') THEN CASE WHEN name IS NULL THEN 'name' END
    WHEN coalesce(file_id, '') = '' THEN 'file_id'
    WHEN kind = 'move_file' AND new_parent_folder_id IS NULL THEN 'new_parent_folder_id'
    WHEN kind IN ('create_permission', 'update_permission') AND role = 'king' THEN 'role'
    WHEN kind = 'create_permission' AND type = 'robot' THEN 'type' END AS error,
    'new_' || left(sha256('create|' || command_id), 16) AS new_id FROM k)
, valid AS (SELECT * FROM checked WHERE error IS NULL)
"""
sql("W01_file_snapshot", ["files", "writes"], NORM + CMD + """
, catalog AS (SELECT id, name, CASE WHEN doc_id % 5 = 0 THEN lang || ' document' END AS description, mime_type, parents, trashed FROM good)
, upd AS (
  SELECT file_id, arg_max(name, seq) FILTER (WHERE name IS NOT NULL) AS name,
    arg_max(description, seq) FILTER (WHERE description IS NOT NULL) AS description,
    arg_max(mime_type, seq) FILTER (WHERE mime_type IS NOT NULL) AS mime_type FROM valid WHERE kind = 'update_file' GROUP BY 1)
, ops AS (
  SELECT file_id, seq, new_parent_folder_id AS p, 1 AS adds FROM valid WHERE kind = 'move_file'
  UNION ALL SELECT file_id, seq, remove_parent, 0 FROM valid WHERE kind = 'move_file' AND remove_parent IS NOT NULL)
, par AS (
  SELECT file_id, p, arg_max(adds, 2 * seq + adds) = 1 AS there, max(seq) FILTER (WHERE adds = 0) AS removed_at,
    min(seq) FILTER (WHERE adds = 1) AS first_added, max(seq) AS last FROM ops GROUP BY 1, 2)
, mov AS (
  SELECT file_id, coalesce(list(p) FILTER (WHERE removed_at IS NOT NULL), []) AS gone,
    coalesce(list(p ORDER BY CASE WHEN removed_at IS NULL THEN first_added ELSE last END, p) FILTER (WHERE there), []) AS added FROM par GROUP BY 1)
, tra AS (SELECT file_id, max(seq) AS s FROM valid WHERE kind IN ('trash_file', 'untrash_file') GROUP BY 1)
, kept AS (
  SELECT c.*, list_filter(CASE WHEN coalesce(c.parents, '') = '' THEN [] ELSE string_split(c.parents, ',') END, lambda x: NOT list_contains(m.gone, x)) AS stay, m.added
  FROM catalog c JOIN mov m ON m.file_id = c.id)
, cur AS (
  SELECT c.id, coalesce(u.name, c.name) AS name, coalesce(u.description, c.description) AS description, coalesce(u.mime_type, c.mime_type) AS mime_type,
    CASE WHEN k.id IS NULL THEN c.parents ELSE array_to_string(k.stay || list_filter(k.added, lambda x: NOT list_contains(k.stay, x)), ',') END AS parent_ids,
    CASE WHEN t.kind IS NOT NULL THEN t.kind = 'trash_file' ELSE c.trashed END AS trashed
  FROM catalog c LEFT JOIN upd u ON u.file_id = c.id LEFT JOIN kept k ON k.id = c.id
  LEFT JOIN (SELECT v.* FROM valid v JOIN tra ON v.seq = tra.s) t ON t.file_id = c.id
  WHERE c.id NOT IN (SELECT file_id FROM valid WHERE kind = 'delete_file'))
SELECT * FROM cur
UNION ALL SELECT new_id, name, description, CASE WHEN kind = 'create_folder' THEN 'application/vnd.google-apps.folder' ELSE coalesce(mime_type, 'application/octet-stream') END,
  coalesce(parent_folder_id, ''), false FROM valid WHERE kind IN ('create_file', 'create_folder')
UNION ALL SELECT v.new_id, coalesce(v.name, 'Copy of ' || c.name), c.description, c.mime_type, coalesce(v.parent_folder_id, c.parents), false
FROM valid v JOIN catalog c ON c.id = v.file_id WHERE v.kind = 'copy_file'""")
sql("W09_permission_snapshot", ["permissions", "writes"], CMD + """
, lastu AS (SELECT file_id, permission_id, arg_max(role, seq) AS role FROM valid WHERE kind = 'update_permission' GROUP BY 1, 2)
SELECT p.file_id, p.permission_id, coalesce(u.role, p.role) AS role, p.kind AS permission_type, p.email AS email_address
FROM permissions p LEFT JOIN lastu u USING (file_id, permission_id)
WHERE NOT EXISTS (SELECT 1 FROM valid v WHERE v.kind = 'delete_permission' AND v.file_id = p.file_id AND v.permission_id = p.permission_id)
UNION ALL SELECT file_id, new_id, role, type, email_address FROM valid WHERE kind = 'create_permission'""")
sql("W12_rejected_commands", ["files", "writes"], NORM + CMD + """
SELECT command_id, operation, error FROM checked WHERE error IS NOT NULL
UNION ALL SELECT command_id, operation, 'not_found' FROM valid WHERE kind NOT IN ('create_file', 'create_folder') AND file_id NOT IN (SELECT id FROM good)""")

sql("Q06_permission", ["permissions", "writes"], CMD + """
SELECT w.file_id, w.permission_id AS id, p.role, p.file_id IS NOT NULL AS found
FROM (SELECT DISTINCT file_id, permission_id FROM writes WHERE file_id IS NOT NULL AND permission_id IS NOT NULL) w
LEFT JOIN (SELECT * FROM permissions WHERE detail_kind <> 2) p ON p.file_id = w.file_id AND p.permission_id = w.permission_id""")

sql("stream_changes", ["changes"], """
SELECT connection_id, page_no, row_number() OVER (PARTITION BY connection_id, page_no ORDER BY seq) - 1 AS seq, file_id, removed,
  coalesce(raw_change_type, 'file') AS change_type, 's/' || page_no AS new_start_page_token FROM changes""")
sql("stream_dedup", ["changes"], NONCE.rstrip() + f""", nt AS (
  SELECT nr.*, c.ts FROM nr JOIN changes c USING (seq))
, acc AS (
  SELECT nonce, min(ts) AS ts FROM nt WHERE nonce <> '' GROUP BY 1
  UNION ALL
  SELECT nonce, nxt FROM (SELECT a.nonce, (SELECT min(c.ts) FROM nt c WHERE c.nonce = a.nonce AND c.ts >= a.ts + INTERVAL {TTL_SECONDS} SECOND) AS nxt FROM acc a)
  WHERE nxt IS NOT NULL)
SELECT acc.nonce, min(c.seq) AS seq, epoch_us(acc.ts) AS at_us FROM acc JOIN nt c ON c.nonce = acc.nonce AND c.ts = acc.ts GROUP BY acc.nonce, acc.ts
UNION ALL SELECT nonce, seq, epoch_us(ts) FROM nt WHERE nonce = ''""")
sql("stream_cursors", ["changes", "state"], CURSORS + """, pg AS (
  SELECT connection_id, page_no, 's/' || max(seq) AS token FROM changes GROUP BY 1, 2)
, half AS (SELECT (min(page_no) + max(page_no)) // 2 AS cut FROM pg)
, known AS (
  SELECT coalesce(c.connection_id, s.connection_id) AS connection_id, coalesce(c.cursor, s.start_cursor) AS page_no
  FROM cur c FULL JOIN (SELECT connection_id, max(page_no) + 1 AS start_cursor FROM pg, half WHERE page_no < cut GROUP BY 1) s ON s.connection_id = c.connection_id)
, moved AS (
  SELECT p.connection_id, max(p.page_no) AS page_no, arg_max(p.token, p.page_no) AS token
  FROM pg p LEFT JOIN known k ON k.connection_id = p.connection_id WHERE k.page_no IS NULL OR p.page_no >= k.page_no GROUP BY 1)
SELECT coalesce(k.connection_id, m.connection_id) AS connection_id, coalesce(m.page_no, k.page_no) AS page_no, m.token
FROM known k FULL JOIN moved m ON m.connection_id = k.connection_id""")
sql("stream_numbered", ["changes"], """
SELECT connection_id, seq, file_id, row_number() OVER (PARTITION BY connection_id ORDER BY seq) AS number FROM changes""")
sql("stream_commands", ["commands"], MSG + """
SELECT route, count(*) AS n FROM m4 WHERE error_field IS NULL AND route IN ('init', 'fetch', 'write', 'teardown', 'capability') GROUP BY 1
UNION ALL SELECT 'validationerror', count(*) FROM m4 WHERE error_field IS NOT NULL HAVING count(*) > 0""")
sql("stream_message_loop", ["commands"], MSG + """
SELECT message_id, route, conn_out AS connection_id,
  CASE WHEN error_field IS NOT NULL THEN 'dead_letter' WHEN route IS NULL THEN 'unhandled' ELSE 'record' END AS output
FROM m4 WHERE route IS DISTINCT FROM 'skipped'""")
sql("stream_retry_loop", ["commands", "webhooks", "connections", "changes", "files", "responses"], NORM + WEBHOOK + MSG + """
, msgs AS (
  SELECT seq, ts, message_id, route, error_field, conn_out, CASE WHEN as_jsonrpc THEN coalesce(least(greatest(max_results, 1), 1000), 100) ELSE 100 END AS page_size,
    coalesce(resource_type, 'files') AS resource_type, operation, seq % 43 <> 0 AS has_payload FROM m4 WHERE route IS DISTINCT FROM 'skipped'
  UNION ALL SELECT seq + 1000000000000, ts, message_id, 'webhook', NULL, NULL, NULL, NULL, NULL, NULL FROM webhooks)
, tries AS (
  SELECT m.seq, a, r.status_code, r.status_code IS NULL OR r.status_code IN (429, 503) AS retriable,
    CASE WHEN r.status_code = 429 THEN CASE WHEN r.retry_after = '30' THEN 30 ELSE 60 END ELSE 2 * 2 ** (a - 1) END AS wait
  FROM msgs m CROSS JOIN (SELECT unnest([1, 2, 3]) AS a) JOIN responses r ON r.response_key = (m.seq * 7 + a) % (SELECT count(*) FROM responses)
  WHERE m.error_field IS NULL AND m.route IN ('init', 'fetch', 'write', 'teardown', 'webhook'))
, ends AS (
  SELECT seq, coalesce(min(a) FILTER (WHERE NOT retriable), 3) AS attempt FROM tries GROUP BY seq)
, asked AS (
  SELECT e.seq, e.attempt, arg_max(t.status_code, t.a) FILTER (WHERE t.status_code IS NOT NULL AND t.a = e.attempt) AS status_code,
    coalesce(sum(t.wait) FILTER (WHERE t.a < e.attempt), 0) AS waited
  FROM ends e JOIN tries t ON t.seq = e.seq AND t.a <= e.attempt GROUP BY ALL)
, live AS (SELECT g.*, c.snowball_id FROM good g JOIN connections c USING (connection_id) WHERE NOT is_trashed AND c.snowball_id IS NOT NULL)
, listed AS (
  SELECT connection_id, 'files' AS resource_type, count(*) AS n FROM live GROUP BY 1
  UNION ALL SELECT connection_id, 'folders', count(*) FROM live WHERE is_folder GROUP BY 1)
, served AS (
  SELECT o.seq + 1000000000000 AS seq, count(*) AS n
  FROM outc o JOIN changes c ON c.connection_id = o.connection_id AND o.token = 'p/' || c.page_no JOIN norm n ON n.doc_id = c.doc_id
  WHERE o.outcome = 'fetch' AND NOT c.removed AND c.file_state = 'file' AND n.bad IS NULL AND o.snowball_id IS NOT NULL
    AND CASE WHEN n.is_folder THEN coalesce(o.sync_folders, true) ELSE coalesce(o.sync_files, true) END GROUP BY 1)
, handled AS (
  SELECT m.*, a.attempt, a.status_code, a.waited, CASE
      WHEN m.error_field IS NOT NULL THEN 'VALIDATIONERROR'
      WHEN m.route IS NULL OR m.route = 'capability' THEN NULL
      WHEN a.status_code = 429 THEN 'RATELIMITERROR' WHEN a.status_code = 401 THEN 'AUTHENTICATIONERROR' WHEN a.status_code = 404 THEN 'TERMINALERROR'
      WHEN a.status_code IS NULL OR a.status_code = 503 THEN 'RETRIABLEERROR'
      WHEN m.route = 'fetch' AND m.resource_type IN ('files', 'folders') AND k.snowball_id IS NULL THEN 'VALIDATIONERROR'
      WHEN m.route = 'write' AND (m.operation IN ('upload_file', 'move_file', 'share_file') OR NOT m.has_payload) THEN 'VALIDATIONERROR'
      WHEN m.route = 'write' AND NOT EXISTS (SELECT 1 FROM good WHERE id = 'f1') THEN 'RESOURCENOTFOUNDERROR'
      WHEN m.route = 'webhook' AND (o.outcome = 'invalid' OR m.seq < 1000000000000) THEN 'VALIDATIONERROR'
      WHEN m.route = 'webhook' AND o.outcome = 'unresolved' THEN 'CONFIGURATIONERROR' END AS error_code,
    coalesce(l.n, 0) AS listed, coalesce(s.n, 0) AS served
  FROM msgs m LEFT JOIN asked a ON a.seq = m.seq LEFT JOIN connections k ON k.connection_id = m.conn_out
  LEFT JOIN listed l ON l.connection_id = m.conn_out AND l.resource_type = m.resource_type
  LEFT JOIN outc o ON o.seq + 1000000000000 = m.seq LEFT JOIN served s ON s.seq = m.seq)
SELECT message_id, route, CASE WHEN error_code IS NOT NULL THEN 'dead_letter' WHEN route IS NULL THEN 'unhandled' ELSE 'done' END AS outcome,
  coalesce(attempt, 1) AS attempt, error_code, epoch_us(ts) + CAST(coalesce(waited, 0) * 1000000 AS BIGINT) AS settled_us,
  CASE WHEN error_code IS NOT NULL OR route IS NULL THEN 0 ELSE CASE route WHEN 'init' THEN 1 WHEN 'capability' THEN 1
    WHEN 'fetch' THEN CASE WHEN resource_type IN ('files', 'folders') THEN greatest(1, least(page_size, listed)) ELSE 0 END
    WHEN 'webhook' THEN served ELSE 0 END END AS records
FROM handled""")
sql("stream_webhooks", ["webhooks", "connections"], WEBHOOK + """
SELECT message_id, connection_id, customer_id, token AS page_token, NULL AS reason FROM outc WHERE outcome = 'fetch'
UNION ALL SELECT message_id, NULL, NULL, NULL, coalesce(error, resolution_error) FROM outc WHERE outcome IN ('invalid', 'unresolved')""")
sql("stream_quota", ["calls"], QUOTA + """
SELECT connection_id, window_start, calls AS n FROM w
WHERE calls > 1 AND (window_start + 100) * 1000000 <= (SELECT max(epoch_us(ts)) - 600000000 FROM calls)""")
sql("stream_quota_all", ["calls"], QUOTA + """
SELECT connection_id, window_start, calls AS n, (window_start + 100) * 1000000 > (SELECT max(epoch_us(ts)) - 600000000 FROM calls) AS open
FROM w WHERE calls > 1""")
