"""Shapes of the landed records and of the typed tables.

Everything below is a fixed value: field names as the admin APIs deliver them,
column names as the star schema publishes them.
"""

from __future__ import annotations

# --- Fixed values: landed record schemas (Spark DDL) -------------------------
RAW_DDL = {
    "capacities": "id STRING, displayName STRING, sku STRING, region STRING, state STRING",
    "workspaces": "id STRING, name STRING, type STRING, state STRING, capacityId STRING",
    "items": (
        "id STRING, name STRING, type STRING, state STRING, lastUpdatedDate STRING, "
        "workspaceId STRING, folderId STRING, "
        "creatorPrincipal STRUCT<displayName: STRING, type: STRING>"
    ),
    "activity": (
        "Id STRING, CreationTime STRING, Operation STRING, Activity STRING, "
        "UserId STRING, UserType BIGINT, Workload STRING, ItemName STRING, "
        "WorkSpaceName STRING, IsSuccess BOOLEAN"
    ),
    "directory_users": (
        "id STRING, displayName STRING, mail STRING, userPrincipalName STRING, userType STRING"
    ),
    "workspace_access": (
        "workspaceId STRING, graphId STRING, displayName STRING, principalType STRING, "
        "identifier STRING, groupUserAccessRight STRING"
    ),
    "item_access": (
        "itemId STRING, workspaceId STRING, "
        "principal STRUCT<id: STRING, displayName: STRING, type: STRING, "
        "userDetails: STRUCT<userPrincipalName: STRING>>, "
        "itemAccessDetails STRUCT<type: STRING, permissions: ARRAY<STRING>>"
    ),
    "tenant_settings": (
        "settingName STRING, title STRING, tenantSettingGroup STRING, enabled BOOLEAN, "
        "canSpecifySecurityGroups BOOLEAN, delegateToCapacity BOOLEAN, "
        "delegateToDomain BOOLEAN, delegateToWorkspace BOOLEAN"
    ),
    "workspace_scan": (
        "id STRING, "
        "datasets ARRAY<STRUCT<id: STRING, name: STRING, "
        "datasourceUsages: ARRAY<STRUCT<datasourceInstanceId: STRING>>>>, "
        "reports ARRAY<STRUCT<id: STRING, name: STRING, datasetId: STRING>>"
    ),
    "capacity_metrics": (
        "date DATE, start_of_hour TIMESTAMP, background_pct DOUBLE, "
        "interactive_pct DOUBLE, capacity_id STRING"
    ),
}

# --- Fixed values: payload array of each page envelope, and the keys of the
# parent a child list was asked for ------------------------------------------
PAGE_ITEMS_KEY = {
    "capacities": "value",
    "workspaces": "workspaces",
    "items": "itemEntities",
    "activity": "activityEventEntities",
    "directory_users": "value",
    "workspace_access": "value",
    "item_access": "accessDetails",
    "tenant_settings": "value",
    "workspace_scan": "workspaces",
}
NEXT_PAGE = "continuationToken"  # on every page but the last of a list
NEXT_PAGE_OF = {"activity": "continuationUri", "directory_users": "@odata.nextLink"}
REQUESTED_PAGE = "_requested"  # written by the extraction: the token that the page answers
PARENT_KEYS = {
    "workspace_access": ("workspaceId",),
    "item_access": ("itemId", "workspaceId"),
}

# --- Fixed values: typed column -> landed field -------------------------------
TYPED_COLUMNS = {
    "capacities": {
        "capacity_id": "id",
        "capacity_name": "displayName",
        "capacity_sku": "sku",
        "capacity_region": "region",
        "capacity_state": "state",
    },
    "workspaces": {
        "workspace_id": "id",
        "workspace_name": "name",
        "workspace_type": "type",
        "workspace_state": "state",
        "capacity_id": "capacityId",
    },
    "items": {
        "item_id": "id",
        "item_name": "name",
        "item_type": "type",
        "item_state": "state",
        "item_last_updated": "lastUpdatedDate",
        "workspace_id": "workspaceId",
        "folder_id": "folderId",
        "creator_name": "creatorPrincipal.displayName",
        "creator_type": "creatorPrincipal.type",
    },
    "activity": {
        "activity_id": "Id",
        "creation_time": "CreationTime",
        "operation": "Operation",
        "activity": "Activity",
        "user_id": "UserId",
        "user_type": "UserType",
        "workload": "Workload",
        "item_name": "ItemName",
        "workspace_name": "WorkSpaceName",
        "is_success": "IsSuccess",
    },
    "workspace_access": {
        "workspace_id": "workspaceId",
        "principal_id": "graphId",
        "role": "groupUserAccessRight",
    },
    "item_access": {
        "item_id": "itemId",
        "workspace_id": "workspaceId",
        "principal_id": "principal.id",
        "principal_display_name": "principal.displayName",
        "user_principal_name": "principal.userDetails.userPrincipalName",
        "principal_type": "principal.type",
        "item_type": "itemAccessDetails.type",
        "permissions": "itemAccessDetails.permissions",
    },
    "tenant_settings": {
        "setting_name": "settingName",
        "title": "title",
        "tenant_setting_group": "tenantSettingGroup",
        "enabled": "enabled",
        "can_specify_security_groups": "canSpecifySecurityGroups",
        "delegate_to_capacity": "delegateToCapacity",
        "delegate_to_domain": "delegateToDomain",
        "delegate_to_workspace": "delegateToWorkspace",
    },
    "capacity_metrics": {
        "date": "date",
        "start_of_hour": "start_of_hour",
        "capacity_id": "capacity_id",
        "background_pct": "background_pct",
        "interactive_pct": "interactive_pct",
    },
}

# --- Fixed values: labels and codes ------------------------------------------
EXTERNAL_TARGET_LABEL = "Fuente Externa"
PRINCIPAL_TYPE_CODES = {"ServicePrincipal": "App"}
USER_TYPE = "User"
GROUP_TYPE = "Group"
SERVICE_TYPE = "Service"
APP_TYPE = "App"
EARLIEST_REAL_DATE = "2000-01-01"

# --- Fixed values: windows and limits ----------------------------------------
ACTIVITY_WINDOW_DAYS = 28
CAPACITY_WINDOW_DAYS = 14
CALENDAR_DAYS_BACK = 365
PREVIEW_ROWS = 1000
FULL_CAPACITY_PCT = 100
RANGE_FLAG_SHARE = 0.003
INTERACTIVE_FLAG_PCT = 0.3
