"""Message definitions for the tests, built as compiled descriptor sets."""

from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

FDP = descriptor_pb2.FieldDescriptorProto


def _field(name, number, kind, repeated=False, type_name=None, oneof=None, optional=False):
    f = FDP(name=name, number=number, type=kind, label=FDP.LABEL_REPEATED if repeated else FDP.LABEL_OPTIONAL)
    if type_name:
        f.type_name = type_name
    if oneof is not None:
        f.oneof_index = oneof
    if optional:
        f.proto3_optional = True
    return f


def _file(name, messages, enums=()):
    file = descriptor_pb2.FileDescriptorProto(name=name, package="t", syntax="proto3")
    file.message_type.extend(messages)
    file.enum_type.extend(enums)
    return file


def _set(*files):
    return descriptor_pb2.FileDescriptorSet(file=files).SerializeToString()


def all_types(extra_field=False):
    """One field per protobuf type, nested, repeated, nested repeated and a map."""
    colour = descriptor_pb2.EnumDescriptorProto(name="colour")
    for i, n in enumerate(["none", "red", "blue"]):
        colour.value.add(name=n, number=i)
    inner = descriptor_pb2.DescriptorProto(name="inner")
    inner.field.extend([_field("tag", 1, FDP.TYPE_STRING), _field("nums", 2, FDP.TYPE_UINT32, repeated=True)])
    m = descriptor_pb2.DescriptorProto(name="all_types")
    entry = m.nested_type.add(name="CountsEntry")
    entry.options.map_entry = True
    entry.field.extend([_field("key", 1, FDP.TYPE_STRING), _field("value", 2, FDP.TYPE_INT64)])
    m.field.extend(
        [
            _field("i32", 1, FDP.TYPE_INT32),
            _field("i64", 2, FDP.TYPE_SINT64),
            _field("u32", 3, FDP.TYPE_UINT32),
            _field("u64", 4, FDP.TYPE_UINT64),
            _field("f32", 5, FDP.TYPE_FLOAT),
            _field("f64", 6, FDP.TYPE_DOUBLE),
            _field("flag", 7, FDP.TYPE_BOOL),
            _field("txt", 8, FDP.TYPE_STRING),
            _field("raw", 9, FDP.TYPE_BYTES),
            _field("col", 10, FDP.TYPE_ENUM, type_name=".t.colour"),
            _field("sub", 11, FDP.TYPE_MESSAGE, type_name=".t.inner"),
            _field("nums", 12, FDP.TYPE_UINT64, repeated=True),
            _field("subs", 13, FDP.TYPE_MESSAGE, repeated=True, type_name=".t.inner"),
            _field("counts", 14, FDP.TYPE_MESSAGE, repeated=True, type_name=".t.all_types.CountsEntry"),
            _field("cols", 15, FDP.TYPE_ENUM, repeated=True, type_name=".t.colour"),
        ]
    )
    if extra_field:
        m.field.append(_field("added", 16, FDP.TYPE_STRING))
    return _set(_file("all.proto", [inner, m], [colour]))


def mobile_share():
    """Two alternative rewards, each with its own key."""
    radio = descriptor_pb2.DescriptorProto(name="radio")
    radio.field.extend(
        [
            _field("hotspot_key", 1, FDP.TYPE_BYTES),
            _field("cbsd_id", 2, FDP.TYPE_STRING),
            _field("poc_reward", 3, FDP.TYPE_UINT64),
            _field("coverage_points", 4, FDP.TYPE_UINT64),
        ]
    )
    gateway = descriptor_pb2.DescriptorProto(name="gateway")
    gateway.field.extend([_field("hotspot_key", 1, FDP.TYPE_BYTES), _field("dc_transfer_reward", 2, FDP.TYPE_UINT64)])
    m = descriptor_pb2.DescriptorProto(name="mobile_share")
    m.oneof_decl.add(name="reward")
    m.field.extend(
        [
            _field("start_period", 1, FDP.TYPE_UINT64),
            _field("end_period", 2, FDP.TYPE_UINT64),
            _field("radio_reward", 3, FDP.TYPE_MESSAGE, type_name=".t.radio", oneof=0),
            _field("gateway_reward", 4, FDP.TYPE_MESSAGE, type_name=".t.gateway", oneof=0),
        ]
    )
    return _set(_file("mobile.proto", [radio, gateway, m]))


def clashing():
    m = descriptor_pb2.DescriptorProto(name="clashing")
    m.field.append(_field("file", 1, FDP.TYPE_STRING))
    return _set(_file("clash.proto", [m]))


def message_class(descriptor_set, name):
    pool = descriptor_pool.DescriptorPool()
    for f in descriptor_pb2.FileDescriptorSet.FromString(descriptor_set).file:
        pool.Add(f)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("t." + name))
