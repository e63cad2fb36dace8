"""Tokenising the phone numbers inside contact documents that arrive as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.codes import VT_TYPES
from tokenloom.functions.text import has_text, looks_like_phone, normalize_mobile
from tokenloom.operators.tokenize import Tokenizer, tokenize_or_lookup
from tokenloom.operators.lookups import join_token

KIND = VT_TYPES["emergency_contact"]
OBJECT = "map<string,variant>"


def _contacts(text: Column) -> Column:
    """The contact objects of a bare array or of a whole document; NULL for any other text."""
    array = F.from_json(F.when(text.startswith("["), text), f"array<{OBJECT}>")
    document = F.from_json(F.when(text.startswith("{"), text), OBJECT)
    inside = document["emergency_contacts"].try_cast(f"array<{OBJECT}>")
    return F.coalesce(array, inside)


def _mobile(contact: Column) -> Column:
    return contact["mobile"].try_cast("string")


def _replace_mobile(contact: Column, token: Column) -> Column:
    """The contact with another mobile, all its other members untouched."""
    return F.transform_values(contact, lambda k, v: F.when(k == "mobile", token.cast("variant")).otherwise(v))


def _write_back(text: Column, contacts: Column) -> Column:
    whole = F.from_json(F.when(text.startswith("{"), text), OBJECT)
    array_text = F.to_json(contacts)
    spliced = F.transform_values(
        whole, lambda k, v: F.when(k == "emergency_contacts", F.parse_json(array_text)).otherwise(v)
    )
    return (
        F.when(contacts.isNull(), text)
        .when(text.startswith("["), array_text)
        .otherwise(F.to_json(spliced))
    )


def tokenize_contacts_json(
    df: DataFrame,
    column: str,
    tokenizer: Tokenizer,
    row_key: str = "id",
    dictionary: DataFrame | None = None,
    **call_options,
) -> DataFrame:
    """Replaces phone-like mobiles by tokens of their international form. Tokens, nulls and blanks
    stay; missing, blank or ``null`` text gives ``[]``; text that is no JSON document stays as is.

    A tokenizer that is an expression works in place. Otherwise the numbers of all rows are
    collected as rows, sent once each, and looked up again per document.
    """
    text = F.trim(F.col(column))
    nothing = F.coalesce((text == "") | (F.lower(text) == "null"), F.lit(True))
    df = df.withColumn("contacts_in", _contacts(text))

    if dictionary is None and tokenizer.column(F.lit(KIND), F.lit("")) is not None:

        def token(contact: Column) -> Column:
            number = _mobile(contact)
            made = tokenizer.column(F.lit(KIND), normalize_mobile(number))
            phone = looks_like_phone(number)
            return F.when(phone, _replace_mobile(contact, made)).otherwise(contact)

        rebuilt = F.transform("contacts_in", token)
        done = _write_back(text, rebuilt)
        return df.withColumn(column, F.when(nothing, "[]").otherwise(done)).drop("contacts_in")

    numbers = df.select(F.col(row_key).alias("doc"), F.explode("contacts_in").alias("contact"))
    numbers = numbers.select("doc", _mobile(F.col("contact")).alias("number")).filter(looks_like_phone("number"))
    numbers = numbers.distinct().withColumn("contact_norm", normalize_mobile("number"))
    if dictionary is not None:
        numbers = join_token(numbers, dictionary, KIND, "contact_norm", "contact_token", "doc")
    else:
        numbers = numbers.withColumn("contact_token", F.lit(None).cast("string"))
    numbers = tokenize_or_lookup(numbers, "contact_norm", "contact_token", KIND, tokenizer, "doc", **call_options)
    numbers = numbers.filter(has_text("contact_token"))
    answers = numbers.groupBy("doc").agg(
        F.map_from_entries(F.collect_list(F.struct("number", "contact_token"))).alias("answers")
    )
    joined = df.join(answers, F.col(row_key) == F.col("doc"), "left")

    def known(contact: Column) -> Column:
        answer = F.try_element_at(F.col("answers"), _mobile(contact))
        return F.when(answer.isNotNull(), _replace_mobile(contact, answer)).otherwise(contact)

    rebuilt = F.transform("contacts_in", known)
    done = _write_back(text, rebuilt)
    return joined.withColumn(column, F.when(nothing, "[]").otherwise(done)).drop("contacts_in", "doc", "answers")
