"""An event report message, used by the registered ingest queries."""

from __future__ import annotations

from google.protobuf import descriptor_pb2

from lakewright.functions.epoch import MILLIS_PER_DAY
from lakewright.sources.messages import MessageFormat

_F = descriptor_pb2.FieldDescriptorProto

# Event kinds by number; 0 is never written.
KINDS = ["unknown", "signup", "purchase", "view", "click", "error"]


def event_report() -> bytes:
    """Compiled descriptor set of ``event_report``: a nested event, tags and a key."""
    kind = descriptor_pb2.EnumDescriptorProto(name="kind")
    for number, name in enumerate(KINDS):
        kind.value.add(name=name, number=number)
    event = descriptor_pb2.DescriptorProto(name="event")
    report = descriptor_pb2.DescriptorProto(name="event_report")
    for message, number, name, field_type, type_name, label in [
        (event, 1, "event_id", _F.TYPE_UINT64, None, _F.LABEL_OPTIONAL),
        (event, 2, "received_timestamp", _F.TYPE_UINT64, None, _F.LABEL_OPTIONAL),
        (event, 3, "user_id", _F.TYPE_INT64, None, _F.LABEL_OPTIONAL),
        (event, 4, "kind", _F.TYPE_ENUM, ".events.kind", _F.LABEL_OPTIONAL),
        (event, 5, "value", _F.TYPE_DOUBLE, None, _F.LABEL_OPTIONAL),
        (report, 1, "event", _F.TYPE_MESSAGE, ".events.event", _F.LABEL_OPTIONAL),
        (report, 2, "tags", _F.TYPE_STRING, None, _F.LABEL_REPEATED),
        (report, 3, "user_key", _F.TYPE_BYTES, None, _F.LABEL_OPTIONAL),
    ]:
        message.field.add(name=name, number=number, type=field_type, type_name=type_name, label=label)
    file = descriptor_pb2.FileDescriptorProto(name="event_report.proto", package="events", syntax="proto3")
    file.enum_type.append(kind)
    file.message_type.extend([event, report])
    return descriptor_pb2.FileDescriptorSet(file=[file]).SerializeToString()


def event_report_format(**options) -> MessageFormat:
    """Bronze table of event reports, dated by the nested receive time."""
    return MessageFormat(event_report(), "event_report", "event.received_timestamp", MILLIS_PER_DAY, **options)
