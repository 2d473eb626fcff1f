"""Provider and method inference from model names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewaste.functions.values import first_match, is_string, is_truthy

# Provider by a fragment of the lowercased model name, first match wins.
PROVIDER_BY_FRAGMENT = [
    ("claude", "anthropic"),
    ("gpt", "openai"),
    ("o1", "openai"),
    ("o3", "openai"),
    ("o4", "openai"),
    ("gemini", "google"),
    ("mistral", "mistral"),
    ("mixtral", "mistral"),
    ("llama", "meta"),
]

# Fixed pattern: vendor prefix of a client class name.
VENDOR_PREFIX = r"^(chat-)?(anthropic|openai|google|vertex|mistral|cohere|meta|together)"


def provider_from_model(model: Column, default: Column) -> Column:
    lowered = F.lower(model)
    return first_match(
        [(lowered.contains(part), F.lit(name)) for part, name in PROVIDER_BY_FRAGMENT], default
    )


def provider_from_parameters(explicit: Column) -> Column:
    """Explicit provider name, lowercased, else ``unknown``."""
    return F.when(
        is_string(explicit) & is_truthy(explicit),
        F.lower(F.try_variant_get(explicit, "$", "string")),
    ).otherwise(F.lit("unknown"))


def provider_from_client_type(client_type: Column, model: Column) -> Column:
    """Vendor named by the client type, else inferred from the model name."""
    text = F.when(is_string(client_type), F.try_variant_get(client_type, "$", "string"))
    vendor = F.regexp_extract(F.lower(text), VENDOR_PREFIX, 2)
    return (
        F.when(vendor == "vertex", F.lit("google"))
        .when(vendor != "", vendor)
        .otherwise(provider_from_model(model, F.lit("unknown")))
    )


def method_from_model(provider: Column, model: Column) -> Column:
    return (
        F.when(F.lower(model).contains("embed"), F.lit("embeddings.create"))
        .when(provider == "anthropic", F.lit("messages.create"))
        .otherwise(F.lit("chat.completions.create"))
    )
