"""Schemas of the raw inputs.

Objects whose key presence matters are maps (a map keeps a key whose value is null); ``size`` and ``quotaBytesUsed``
are variants, because a JSON number and a JSON string parse differently.
"""

USER = "map<string,string>"

RAW_FILE = """
    id string, name string, mimeType string, size variant, quotaBytesUsed variant, version string,
    createdTime string, modifiedTime string, viewedByMeTime string, sharedWithMeTime string, trashedTime string,
    webViewLink string, webContentLink string, thumbnailLink string,
    md5Checksum string, sha1Checksum string, sha256Checksum string, description string, folderColorRgb string,
    trashed boolean, explicitlyTrashed boolean, starred boolean, shared boolean, viewedByMe boolean,
    parents array<string>, owners array<map<string,string>>, lastModifyingUser map<string,string>,
    permissions array<string>, capabilities map<string,boolean>
"""

RAW_REVISION = """
    id string, mimeType string, modifiedTime string, size variant, md5Checksum string,
    keepForever boolean, published boolean, publishAuto boolean, publishedOutsideDomain boolean,
    lastModifyingUser map<string,string>, exportLinks map<string,string>
"""

PERMISSION_DETAIL = "map<string,string>"

RAW_PERMISSION = """
    id string, type string, role string, displayName string, emailAddress string, domain string, photoLink string,
    expirationTime string, allowFileDiscovery boolean, deleted boolean, pendingOwner boolean,
    permissionDetails array<map<string,string>>, teamDrivePermissionDetails array<map<string,string>>
"""

RAW_COMMENT = """
    id string, content string, createdTime string, modifiedTime string, resolved boolean, deleted boolean,
    author map<string,string>, replies array<string>
"""

RAW_REPLY = """
    id string, content string, createdTime string, modifiedTime string, deleted boolean, author map<string,string>
"""

LIST_PAGE = "files array<string>, nextPageToken string"

CHANGE_PAGE = """
    changes array<struct<file: string, fileId: string, removed: boolean, changeType: string, time: string>>,
    nextPageToken string, newStartPageToken string
"""

MESSAGE_PARAMS = """
    struct<
        header: struct<parameters: map<string,string>>,
        resource_type: string, operation: string, payload: map<string,string>,
        credentials: struct<access_token: string>,
        metadata: struct<snowball_id: string, external_id: string, connection_config: string>,
        filters: struct<query: string, trashed: boolean, id: string>,
        pagination: struct<page_token: string, max_results: int>,
        config: struct<setup_webhook: boolean, webhook_url: string>
    >
"""

MESSAGE = f"""
    id string, jsonrpc string, method string, params {MESSAGE_PARAMS},
    message_id string, customer_id string, integration_id string, integration_connection_id string,
    action string, resource_type string, operation string, trigger_type string, trace_id string,
    payload map<string,string>, last_cursor string
"""

CONNECTION = """
    connection_id string, customer_id string, snowball_id string, external_id string,
    access_token string, refresh_token string,
    settings struct<sync_files: boolean, sync_folders: boolean, sync_shared_drives: boolean>
"""

CONNECTION_STATE = "connection_id string, key string, value string, updated_at timestamp, seq bigint"

API_CALL_LOG = """
    ts timestamp, connection_id string, endpoint string, status_code int, retry_after string, latency_ms double,
    body string
"""
