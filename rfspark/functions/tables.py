"""They must equal the device's and file format's own."""

# Bytes of one I/Q pair per stream format; JSON has no fixed width.
IQ_BYTES = {"int16": 4, "float16": 4, "float32": 8}

# Receiver clock labels and their physical rates.
RECEIVER_CLOCKS_HZ = {
    "46MHz": 46_080_000.0,
    "61MHz": 61_440_000.0,
    "76MHz": 76_800_000.0,
    "77MHz": 76_800_000.0,
    "92MHz": 92_160_000.0,
    "122MHz": 122_880_000.0,
    "184MHz": 184_320_000.0,
    "245MHz": 245_760_000.0,
    "492MHz": 491_520_000.0,
}
DEFAULT_RECEIVER_CLOCK_HZ = 92_160_000.0
IQ_RATE_CLOCK_RATIO = 1.5
IQ_CLOCK_HZ = 61_440_000.0
USABLE_BANDWIDTH_RATIO = 0.8
LADDER_TOP_TOLERANCE = 0.01
LADDER_RUNGS = 10
MAX_LADDER_RUNGS = 64
DEFAULT_INT16_SCALE = 32768.0

# Limits on what a header may claim.
MAX_PAYLOAD_BYTES = 256 * 1024 * 1024
MAX_HEADER_BYTES = 10 * 1024 * 1024
MAX_CHUNK_BYTES = 1_000_000_000
MAX_BLOCK_VALUES = 1 << 24

# File sample types by code, with the bytes of one value.
SAMPLE_TYPES = ["U8", "U16", "S16", "U32", "S32", "F32", "U8N", "U16N", "S16N", "U32N", "S32N", "F32N"]
SAMPLE_WIDTHS = [1, 2, 2, 4, 4, 4, 1, 2, 2, 4, 4, 4]

SAMPLE_UNITS = [
    "Generic", "Dbm", "Percentage", "DbmHz", "DbmM2", "Index", "Phase", "Signed1", "Unsigned1", "Time",
    "DateTime", "Hz", "HzLog", "Watt", "Sector", "Symbol", "Db", "Numeric", "HzLogCenter", "Volt",
    "LogPercentage",
]

FILE_PAYLOADS = [
    "Generic", "Audio", "Iq", "Spectra", "Detection", "Histogram", "Energy", "Vector3", "Structured",
    "IqSlice", "Image",
]

DEVICE_STATES = [
    "unknown", "idle", "booting", "ready", "starting", "operational", "running", "warning", "critical",
]

PACKET_FLAGS = {
    "STREAM_START": 0x00000001,
    "STREAM_END": 0x00000002,
    "SEGMENT_START": 0x00000004,
    "SEGMENT_END": 0x00000008,
    "BREAK": 0x00000010,
    "FLUSH": 0x00000020,
    "PACKET_START": 0x00000040,
    "PACKET_END": 0x00000080,
    "WARN_OVERFLOW": 0x00000100,
    "WARN_DROPPED": 0x00000200,
    "WARN_INACCURATE": 0x00000400,
    "WARN_RESAMPLED": 0x00000800,
    "REPLAY": 0x00001000,
    "IMMEDIATE": 0x00002000,
    "TIME_OVERLAP": 0x00004000,
    "PUSH": 0x00008000,
    "TIME_DISCONTINUITY": 0x00010000,
    "WARN_DIRECTION": 0x00020000,
    "REJECTED": 0x00100000,
    "USER_0": 0x01000000,
    "USER_1": 0x02000000,
    "USER_2": 0x04000000,
    "USER_3": 0x08000000,
    "CONDITION_0": 0x10000000,
    "CONDITION_1": 0x20000000,
    "CONDITION_2": 0x40000000,
    "CONDITION_3": 0x80000000,
}

CHUNK_IDS = ["DSFH", "STRM", "SSTR", "SSCA", "ANTA", "ANTS", "MDTT", "SPRV", "STRT", "SAMP", "DSFT"]
