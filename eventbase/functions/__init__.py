from eventbase.functions.json_records import parse_events
from eventbase.functions.keys import app_key_of, application_key, event_type_of, message_key

__all__ = ["app_key_of", "application_key", "event_type_of", "message_key", "parse_events"]
