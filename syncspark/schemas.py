"""Declared schemas and fixed values shared by batch and streaming jobs.

Ids are 64-bit everywhere, so an id above 2^31 survives parsing.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, length limits, state tags and formats that other
# systems rely on.
NAME_LIMIT = 255
STATE_LIMIT = 50
STATE_INSERT = "INSERT"
STATE_UPDATE = "UPDATE"
STATE_DELETE = "DELETE"
CURSOR_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SAVE_MODES = ("append", "overwrite", "ignore", "error", "errorifexists")
JDBC_BATCH_ROWS = 1000
SENT_BUFFER_ROWS = 1000
TRIGGER_INTERVAL = "1 second"
ENTITY_PREFIX = "user"
TABLE_NAMES = ("Users", "Repositories")
LOG_TABLE_NAMES = ("user_log_before", "user_log_after")


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_id, _text = T.LongType(), T.StringType()

ACTOR = _struct(id=_id, login=_text, gravatar_id=_text, url=_text, avatar_url=_text)
REPO = _struct(id=_id, name=_text, url=_text)
RAW_EVENT = _struct(actor=ACTOR, repo=REPO)

USERS = _struct(user_id=_id, login=_text, gravatar_id=_text, avatar_url=_text, url=_text)
REPOSITORIES = _struct(repo_id=_id, name=_text, url=_text)
CHANGE_LOG = T.StructType(
    USERS.fields
    + [T.StructField("state", _text, True), T.StructField("log_timestamp", T.TimestampType(), True)]
)
REFUSED = _struct(target=_text, value=_text, violations=_text)
MESSAGE = T.StructType(
    USERS.fields + [T.StructField("state", _text, True), T.StructField("log_timestamp", _text, True)]
)

USERS_REQUIRED = ("user_id", "login")
REPOSITORIES_REQUIRED = ("repo_id", "name")
MESSAGE_REQUIRED = USERS_REQUIRED
