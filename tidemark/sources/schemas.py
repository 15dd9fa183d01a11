"""Record shapes, as Spark DDL."""

# A log record, as the Kafka source yields it.
LOG_RECORD = (
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
)

# A change event. The document stays an open map, so a job parses only one
# level of it and any field can still be reached through the variant values.
# Ids and dates are read openly because each has two shapes in the wild.
CHANGE_EVENT = """
    operationType string,
    clusterTime struct<`$timestamp`: struct<t: bigint, i: bigint>, t: bigint, i: bigint>,
    wallTime struct<`$date`: string>,
    fullDocument map<string, variant>,
    updateDescription struct<updatedFields: map<string, variant>,
                             removedFields: array<string>,
                             truncatedArrays: array<string>>,
    ns struct<db: string, coll: string>,
    documentKey struct<_id: variant>,
    _malformed string
"""

# The same for jobs that read the documents apart, with their numbers as they
# are written (see ``envelope.parse_changes``). The document is named so that a
# record which breaks off inside it still tells its key.
CHANGE_HEAD = """
    operationType string,
    clusterTime struct<`$timestamp`: struct<t: bigint, i: bigint>, t: bigint, i: bigint>,
    wallTime struct<`$date`: string>,
    fullDocument string,
    updateDescription struct<removedFields: array<string>,
                             truncatedArrays: array<string>>,
    ns struct<db: string, coll: string>,
    documentKey struct<_id: variant>,
    _malformed string
"""

# The document fields that the lookups read.
KEYWORD_KEYS = """
    eligibility struct<name: string,
                       start_period: struct<`$date`: string>,
                       end_period: struct<`$date`: string>,
                       program_id: struct<_id: variant>>
"""

# A small change event: id, keyword text and points only.
POINTS_EVENT = """
    operationType string,
    fullDocument struct<_id: variant, keyword: string, points: int>,
    documentKey struct<_id: variant>
"""

REDEEM_EVENT = """
    data struct<locale: string, msisdn: string, keyword: string, keyword_id: string,
                transaction_id: string, channel_id: string, callback_url: string,
                transaction_source: string, send_notification: boolean,
                additional: map<string, string>>,
    account struct<_id: variant, user_id: string>,
    token string,
    transaction_id string,
    path string,
    keyword_priority string,
    _malformed string
"""
