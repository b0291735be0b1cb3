"""Replacing personal data by constants and values derived from ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values that masked columns receive.
FIRST_NAMES = "John"
MIDDLE_NAME = "Peter"
DATE_OF_BIRTH = "1900-01-01"
COMPANY_INFO = ""
TRADING_AS = " "
PHONE = "+31(99)1234567"
PHONE_SEARCH = "1234567"
FAX_BUSINESS = "+31(99)2345678"
FAX_HOME = "+31(99)1234567"
WEB_PAGE = "localhost"
EMAIL = "everyone@internet.com"
TAX_NO = "XX000000000"
DRIVERS_LICENSE_NO = "XX0000"
BUSINESS_REF_NO = "KVK Earth"
INVOICE_NAME = "Dear Customer"
NATIONAL_NO = "123"
PASSPORT_NO = "123"
IDENTIFICATION_REF = "abc"
DUNS_NUMBER = "123"
JOB_TITLE = "Head Chef"
BANK_CODE = "0123456789"
BRANCH_CODE = "123456"
BRANCH_ADDRESS = "Street1"
ZIP_CODE = "E14 5HQ"

# Party categories with the prefix of the name, the prefix of the external name and the
# party type codes. A party of none of them is a customer.
CATEGORIES = (
    ("vendor", "V_Customer", "V_Customer", (4,)),
    ("insurance", "I_Customer", "I_Customer", (16,)),
    ("manufacturer", "M_Customer", "M_Customer", (32,)),
    ("tax_authority", "T_Customer", "T_Customer", (64,)),
    ("broker", "BR_Customer", "B_Customer", (256, 258, 262, 272)),
    (
        "dealer",
        "D_Customer",
        "D_Customer",
        (512, 513, 514, 516, 518, 528, 530, 544, 546, 768, 770, 786, 784, 2818, 2816, 2562, 2560, 2304),
    ),
    ("registration", "R_Customer", "R_Customer", (1024,)),
)
CUSTOMER_PREFIX = "C_Customer"
# Manufacturers are masked even when flagged as a unit or branch.
ALWAYS_MASKED = (32,)

# List types that hold mail addresses, and external users.
MAIL_LIST_TYPES = (50701, 50702, 50703, 50704, 50705, 50706, 50710)
EXTERNAL_USER_TYPES = (16801, 16803)

# Tables whose audit rows hold personal data.
PERSONAL_TABLES = ("party", "party_account", "party_address", "party_bankacc", "address")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def party_category(party_type: str = "party_type") -> Column:
    choice = None
    for name, _, _, codes in CATEGORIES:
        hit = F.col(party_type).isin(*codes)
        choice = F.when(hit, name) if choice is None else choice.when(hit, name)
    return choice.otherwise("customer")


def _prefix(position: int, party_type: str = "party_type") -> Column:
    choice = None
    for category in CATEGORIES:
        hit = F.col(party_type).isin(*category[3])
        choice = F.when(hit, category[position]) if choice is None else choice.when(hit, category[position])
    return choice.otherwise(CUSTOMER_PREFIX)


def is_masked_party() -> Column:
    """Parties that get masked: no system rows, no own units or branches (except manufacturers)."""
    outside = (F.col("is_business_unit") == 0) & (F.col("is_branch") == 0)
    return (F.col("party_id") > 0) & (outside | F.col("party_type").isin(*ALWAYS_MASKED))


def _party_values() -> dict[str, Column]:
    number = _text("party_no")
    return {
        "name": F.concat(_prefix(1), number),
        "ext_name": F.concat(_prefix(2), number),
        "first_names": F.lit(FIRST_NAMES),
        "middle_name": F.lit(MIDDLE_NAME),
        "date_of_birth": F.lit(DATE_OF_BIRTH).cast("date"),
        "company_info": F.lit(COMPANY_INFO),
        "trading_as": F.lit(TRADING_AS),
        "phone_business": F.lit(PHONE),
        "phone_business_search": F.lit(PHONE_SEARCH),
        "fax_business": F.lit(FAX_BUSINESS),
        "web_page": F.lit(WEB_PAGE),
        "email_business": F.lit(EMAIL),
        "email_home": F.lit(EMAIL),
        "tax_no": F.concat(F.lit(TAX_NO), number),
        "drivers_license_no": F.concat(F.lit(DRIVERS_LICENSE_NO), number),
        "business_ref_no": F.lit(BUSINESS_REF_NO),
        "business_ref_no2": F.lit(BUSINESS_REF_NO),
        "business_ref_no3": F.lit(BUSINESS_REF_NO),
        "invoice_name": F.lit(INVOICE_NAME),
        "phone_home": F.lit(PHONE),
        "phone_home_search": F.lit(PHONE_SEARCH),
        "phone_mobile": F.lit(PHONE),
        "phone_mobile_search": F.lit(PHONE_SEARCH),
        "fax_home": F.lit(FAX_HOME),
        "national_no": F.lit(NATIONAL_NO),
        "passport_location_id": F.lit(0),
        "passport_no": F.lit(PASSPORT_NO),
        "identification_ref1": F.lit(IDENTIFICATION_REF),
        "identification_ref2": F.lit(IDENTIFICATION_REF),
        "duns_number": F.lit(DUNS_NUMBER),
    }


def mask(df: DataFrame, values: dict[str, Column], where: Column | None = None) -> DataFrame:
    """Replace the columns that the frame has; one projection, no shuffle."""
    columns = []
    for name in df.columns:
        if name not in values:
            columns.append(F.col(name))
            continue
        value = values[name].cast(df.schema[name].dataType)
        columns.append((value if where is None else F.when(where, value).otherwise(F.col(name))).alias(name))
    return df.select(*columns)


def mask_parties(party: DataFrame) -> DataFrame:
    return mask(party, _party_values(), is_masked_party())


def mask_party_accounts(account: DataFrame) -> DataFrame:
    return mask(account, {"name": F.concat(F.lit("PartyAcc "), _text("party_account_id"))}, F.col("party_account_id") > 0)


def mask_bank_accounts(bankacc: DataFrame) -> DataFrame:
    values = {
        "code": F.lit(BANK_CODE),
        "name": F.lit("Bank"),
        "ext_name": F.lit("Bank"),
        "branch_code": F.lit(BRANCH_CODE),
        "branch_address": F.lit(BRANCH_ADDRESS),
    }
    return mask(bankacc, values, F.col("bankacc_id") > 0)


def mask_duplicate_buckets(bucket: DataFrame) -> DataFrame:
    return mask(bucket, {"word": F.concat("soundex_value", "bucket_value")})


def mask_party_addresses(address: DataFrame) -> DataFrame:
    values = {"street": F.concat(F.lit("Sesame Street "), _text("party_id")), "zip_code": F.lit(ZIP_CODE)}
    return mask(address, values, F.col("party_address_id") > 0)


def mask_addresses(address: DataFrame) -> DataFrame:
    return mask(address, {"street": F.concat(F.lit("Sesame street "), _text("address_id")), "zip_code": F.lit(ZIP_CODE)})


def mask_bank_flows(bank_flow: DataFrame) -> DataFrame:
    prefixes = {
        "party_name": "Party",
        "party_bank_name": "Bank",
        "party_bank_account_name": "BankAccName",
        "party_bank_account_no": "BankAccNo",
        "party_account_name": "PartyAccName",
    }
    return mask(bank_flow, {column: F.concat(F.lit(text), _text("bank_flow_id")) for column, text in prefixes.items()})


def mask_employment(info: DataFrame) -> DataFrame:
    return mask(info, {"gross_income": F.lit(0), "employee_id": F.lit(0), "job_title": F.lit(JOB_TITLE)})


def mask_users(user: DataFrame) -> DataFrame:
    return mask(user, {"email": F.lit(EMAIL)}, F.col("external_user_type").isin(*EXTERNAL_USER_TYPES))


def mask_mail_lists(doc_list: DataFrame) -> DataFrame:
    filled = F.col("list_type").isin(*MAIL_LIST_TYPES) & (F.length("list_value") > 0)
    return mask(doc_list, {"list_value": F.lit(EMAIL)}, filled)


def mask_coverage(party: DataFrame) -> DataFrame:
    """Per category: parties, those to be masked, and the values that masking leaves as they were.

    The mask is a projection, so that old and new values of a row are compared in one pass. Every masked column that
    the frame has is counted, over all parties but the system row: `n_unmasked` is the values still the same in
    parties to be masked (a value that was its own mask counts as well), `n_exempt_values` those of all others.
    """
    values = {name: value for name, value in _party_values().items() if name in party.columns}
    hit = is_masked_party()
    same = F.lit(0)
    for name, value in values.items():
        new = F.when(hit, value.cast(party.schema[name].dataType)).otherwise(F.col(name))
        same = same + F.when(F.col(name).isNotNull() & (F.col(name) == new), 1).otherwise(0)
    judged = party.where("party_id > 0").select(party_category().alias("category"), hit.alias("_hit"), same.alias("_same"))
    return judged.groupBy("category").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_parties"),
        F.count_if("_hit").cast("bigint").alias("n_to_mask"),
        F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_same"))), F.lit(0)).cast("bigint").alias("n_unmasked"),
        F.coalesce(F.sum(F.when(~F.col("_hit"), F.col("_same"))), F.lit(0)).cast("bigint").alias("n_exempt_values"),
    )


def scrub_audit(audit: DataFrame, header: DataFrame, tables=PERSONAL_TABLES) -> DataFrame:
    """Blank the old and new values of audit rows that belong to personal tables."""
    marks = header.where(F.col("tbl_name").isin(*tables)).select("audit_hdr_id", F.lit(True).alias("_personal"))
    hit = F.col("_personal")
    joined = audit.join(marks, "audit_hdr_id", "left")
    return joined.select(
        *[
            F.when(hit, F.lit("")).otherwise(F.col(c)).alias(c) if c in ("old_fld_value", "new_fld_value") else F.col(c)
            for c in audit.columns
        ]
    )


def scrub_notes(note: DataFrame, subject_pattern: str = "%party%") -> DataFrame:
    """Blank the comments of notes whose subject matches."""
    return mask(note, {"comments": F.lit("")}, F.col("subject").ilike(subject_pattern))
