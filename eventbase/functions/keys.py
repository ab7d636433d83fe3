"""Composite message keys: ``<application key>|<event type>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separator of the message key format.
KEY_SEPARATOR = "|"


def message_key(app_key: Column, event_type: Column) -> Column:
    """Render the key. A null part gives a null key, so such a message is never routed."""
    return F.concat(app_key, F.lit(KEY_SEPARATOR), event_type)


def app_key_of(key: Column) -> Column:
    return F.when(F.contains(key, F.lit(KEY_SEPARATOR)), F.substring_index(key, KEY_SEPARATOR, 1))


def event_type_of(key: Column) -> Column:
    """Everything after the first separator, so an event type may hold one itself."""
    at = F.instr(key, KEY_SEPARATOR)
    return F.when(at > 0, F.substr(key, at + 1))


def data_key(key: Column) -> Column:
    return F.struct(app_key_of(key).alias("app_key"), event_type_of(key).alias("event_type"))


def application_key(account: Column, application: Column) -> Column:
    """Identifier handed to an application on registration; not a secret.

    The two names are hashed as a JSON array, because joining them with a plain
    separator would give ("a:b", "c") and ("a", "b:c") the same identifier.
    """
    return F.sha2(F.to_json(F.array(account, application)), 256)
