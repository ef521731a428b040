"""Failure kinds: reason codes, error text, transient or permanent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Queue manager reason code -> error kind. Any other code is TRANSPORT.
REASON_KINDS = {
    2035: "AUTHENTICATION",  # not authorised
    2063: "AUTHENTICATION",  # security error
    2059: "CONNECTION",  # queue manager not available
    2009: "CONNECTION",  # connection broken
    2538: "CONNECTION",  # host not available
    2537: "CONNECTION",  # channel not available
    2085: "CONFIGURATION",  # unknown object name
    2058: "CONFIGURATION",  # queue manager name error
    2003: "ROLLED_BACK",  # backed out
}

# Message prefix per error kind.
KIND_PREFIXES = {
    "AUTHENTICATION": "Authentication failed: ",
    "CONNECTION": "Connection failed: ",
    "CONFIGURATION": "Configuration error: ",
    "ROLLED_BACK": "Transaction rolled back: ",
    "PARSE": "Parse failed: ",
    "RECEIVE": "Receive failed: ",
    "SEND": "Send failed: ",
    "TRANSPORT": "Transport error: ",
}

# Exception classes that never succeed on retry; neither do their subclasses.
PERMANENT_CLASSES = (
    "java.lang.IllegalArgumentException",
    "java.lang.NullPointerException",
    "java.lang.UnsupportedOperationException",
    "java.lang.ClassCastException",
    "java.lang.SecurityException",
)

# Superclasses by package and simple names, as the JDK and Spark declare them.
_SUBCLASSES = {
    "java.lang.IllegalArgumentException": {
        "java.lang": "NumberFormatException IllegalThreadStateException IllegalCallerException LayerInstantiationException",
        "java.util": "IllegalFormatException IllformedLocaleException",
        "java.util.regex": "PatternSyntaxException",
        "java.nio.charset": "IllegalCharsetNameException UnsupportedCharsetException",
        "java.nio.channels": "IllegalSelectorException IllegalChannelGroupException UnresolvedAddressException UnsupportedAddressTypeException",
        "java.nio.file": "InvalidPathException ProviderMismatchException",
        "java.security": "InvalidParameterException",
        "org.apache.spark": "SparkIllegalArgumentException",
    },
    "java.lang.NumberFormatException": {"org.apache.spark": "SparkNumberFormatException"},
    "java.util.IllegalFormatException": {
        "java.util": "DuplicateFormatFlagsException FormatFlagsConversionMismatchException IllegalFormatCodePointException "
        "IllegalFormatConversionException IllegalFormatFlagsException IllegalFormatPrecisionException IllegalFormatWidthException "
        "IllegalFormatArgumentIndexException MissingFormatArgumentException MissingFormatWidthException "
        "UnknownFormatConversionException UnknownFormatFlagsException",
    },
    "java.lang.UnsupportedOperationException": {
        "java.nio": "ReadOnlyBufferException",
        "java.nio.file": "ReadOnlyFileSystemException",
        "org.apache.spark": "SparkUnsupportedOperationException",
    },
    "java.lang.ClassCastException": {"org.apache.spark": "SparkClassCastException"},
    "java.lang.SecurityException": {
        "java.security": "AccessControlException",
        "java.rmi": "RMISecurityException",
        "org.apache.spark": "SparkSecurityException",
    },
}
SUPERCLASSES = {f"{p}.{n}": top for top, packages in _SUBCLASSES.items() for p, names in packages.items() for n in names.split()}


def permanent_classes(superclasses: dict[str, str] = SUPERCLASSES) -> list[str]:
    """The permanent classes and all that descend from them."""

    def descends(name: str) -> bool:
        seen = set()
        while name not in PERMANENT_CLASSES and name in superclasses and name not in seen:
            seen.add(name)
            name = superclasses[name]
        return name in PERMANENT_CLASSES

    return sorted({*PERMANENT_CLASSES, *filter(descends, superclasses)})


# Name under which the connector's own errors are logged; those are judged by their text.
CONNECTOR_ERROR = "ConnectorException"


def _lookup(table: dict, key: Column) -> Column:
    pairs = [F.lit(part) for entry in table.items() for part in entry]
    return F.element_at(F.create_map(*pairs), key)


def reason_kind(reason_code: Column) -> Column:
    return F.coalesce(_lookup(REASON_KINDS, reason_code.cast("int")), F.lit("TRANSPORT"))


def error_text(kind: Column, message: Column, reason_code: Column, completion_code: Column) -> Column:
    """Message with its kind's prefix and, where known, ``[reasonCode=.., completionCode=..]``."""
    codes = (
        F.when(reason_code.isNull(), "")
        .when(completion_code.isNull(), F.concat(F.lit(" [reasonCode="), reason_code, F.lit("]")))
        .otherwise(
            F.concat(F.lit(" [reasonCode="), reason_code, F.lit(", completionCode="), completion_code, F.lit("]"))
        )
    )
    return F.concat(F.coalesce(_lookup(KIND_PREFIXES, kind), F.lit("")), message, codes)


def classify(error_class: Column, message: Column, superclasses: dict[str, str] = SUPERCLASSES) -> Column:
    """struct(failureType, reason). Connector errors go by text, first match wins; others by class and
    superclasses (add your own classes to ``superclasses``); what is not known to be permanent is worth a retry."""
    own = F.element_at(F.split(error_class, r"[.$]"), -1) == CONNECTOR_ERROR
    text = F.coalesce(message, F.element_at(F.split(error_class, r"\."), -1))
    lower = F.lower(text)
    auth, config = own & lower.contains("auth"), own & lower.contains("config")
    parse = own & (lower.contains("parse") | lower.contains("invalid format"))
    permanent = auth | config | parse | (~own & error_class.isin(*permanent_classes(superclasses)))
    prefix = (
        F.when(auth, "Authentication error: ").when(config, "Configuration error: ").when(parse, "Parse error: ")
    )
    return F.struct(
        F.when(permanent, "PERMANENT").otherwise("TRANSIENT").alias("failureType"),
        F.concat(F.coalesce(prefix, F.lit("")), text).alias("reason"),
    )
