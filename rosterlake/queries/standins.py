"""Profiles made from the ``customer`` and ``orders`` tables, in every shape the readers take.

Spark expressions and SQL here describe the same rows; faults are spread over the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# -- clean profiles from customers -----------------------------------------------------------

PROFILE_SQL = """
select c_custkey as id,
       'test' || c_custkey || '@test.com' as email,
       case when c_custkey % 9 = 0 then '0000-00-00'
            else cast(date '1950-01-01' + cast(c_custkey % 15000 as integer) as varchar) end as dob,
       cast(40000 + (c_custkey * 7) % 80000 as integer) as weight,
       cast(150 + c_custkey % 50 as integer) as height,
       c_name as nickname,
       cast(c_nationkey as integer) as country,
       c_mktsegment as city,
       'seg ' || c_mktsegment as caption,
       cast((c_custkey * 37) % 361 - 180 as double) as lon,
       cast((c_custkey * 17) % 181 - 90 as double) as lat,
       cast(1 + c_custkey % 2 as integer) as gender
from customer
"""


def _fields() -> dict[str, Column]:
    """The fields of a profile made from a customer."""
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1950-01-01").cast("date"), (key % 15000).cast("int")).cast("string")
    return {
        "id": key,
        "email": F.concat(F.lit("test"), key, F.lit("@test.com")),
        "dob": F.when(key % 9 == 0, F.lit("0000-00-00")).otherwise(born),
        "weight": (40000 + (key * 7) % 80000).cast("int"),
        "height": (150 + key % 50).cast("int"),
        "nickname": F.col("c_name"),
        "country": F.col("c_nationkey").cast("int"),
        "city": F.col("c_mktsegment"),
        "caption": F.concat(F.lit("seg "), "c_mktsegment"),
        "location": F.struct(
            ((key * 37) % 361 - 180).cast("double").alias("lon"),
            ((key * 17) % 181 - 90).cast("double").alias("lat"),
        ),
        "gender": (1 + key % 2).cast("int"),
    }


def profiles(customer: DataFrame) -> DataFrame:
    return customer.select(*[value.alias(name) for name, value in _fields().items()])


# -- delimited lines -------------------------------------------------------------------------

FAULTS = 23  # kinds of lines, by customer key


def delimited_lines(customer: DataFrame) -> DataFrame:
    """``value``: one line per customer, most kinds with something wrong or unusual."""
    p = profiles(customer)
    kind = F.col("id") % FAULTS

    def field(value, **odd):
        for k, text in odd.items():
            value = F.when(kind == int(k[1:]), F.lit(text)).otherwise(value)
        return value

    pnum = field(F.col("id").cast("string"), k3="x1", k10="p")
    lon = field(F.col("location.lon").cast("string"), k4="abc", k11="", k17="0")
    lat = field(F.col("location.lat").cast("string"), k5="1.0d", k18="1.5e1")
    weight = field(F.col("weight").cast("string"), k6=" 5 ", k10="w")
    height = field(F.col("height").cast("string"), k7="5.0")
    country = field(F.col("country").cast("string"), k8="")
    gender = field(F.col("gender").cast("string"), k9="99999999999")
    caption = field(
        F.col("caption"), k12='"open', k13='"a|b"', k14='"say ""hi"""', k15='it"s', k16='""', k19='"ab"cd"')
    full = F.concat_ws("|", pnum, lon, lat, "email", weight, height, "nickname", country, "city", caption, gender)
    line = (
        F.when(kind == 1, full)
        .when(kind == 2, F.concat(full, F.lit("|"), F.col("dob"), F.lit("|x")))
        .otherwise(F.concat(full, F.lit("|"), F.col("dob")))
    )
    return p.select(line.alias("value"))


LINE_REASON_SQL = """
case c_custkey % 23
  when 1 then 'wrong_field_count' when 2 then 'wrong_field_count' when 12 then 'wrong_field_count'
  when 3 then 'bad_pnum' when 10 then 'bad_pnum'
  when 4 then 'bad_lon' when 11 then 'bad_lon'
  when 5 then 'bad_lat' when 6 then 'bad_weight' when 7 then 'bad_height'
  when 8 then 'bad_country' when 9 then 'bad_gender' end
"""

TYPED_SQL = f"""
select p.id, p.email, p.dob, p.weight, p.height, p.nickname, p.country, p.city,
       case k when 13 then 'a|b' when 14 then 'say "hi"' when 15 then 'it"s' when 16 then ''
              when 19 then 'ab"cd' else p.caption end as caption,
       case k when 17 then 0.0 else p.lon end as lon,
       case k when 18 then 15.0 else p.lat end as lat,
       p.gender,
       (case k when 17 then 0.0 else p.lon end) = 0 or (case k when 18 then 15.0 else p.lat end) = 0
         as suspect_location
from (select *, id % 23 as k from ({PROFILE_SQL})) p
join (select c_custkey, {LINE_REASON_SQL} as reason from customer) r on r.c_custkey = p.id
where r.reason is null
"""

# -- JSON messages ---------------------------------------------------------------------------


def json_messages(customer: DataFrame, whole: bool = False) -> DataFrame:
    """``key`` and ``value``: one JSON text per customer, some of them faulty; ``whole`` ones have all fields."""
    key = F.col("c_custkey")
    bare = F.concat(F.lit('{"id":'), key, F.lit(',"nickname":"'), F.col("c_name"), F.lit('"'))
    head = bare
    if whole:
        p = _fields()
        city = F.when(key % 13 != 8, F.concat(F.lit(',"city":"'), p["city"], F.lit('"'))).otherwise(F.lit(""))
        head = F.concat(
            bare, F.lit(',"email":"'), p["email"], F.lit('","dob":"'), p["dob"], F.lit('","weight":'), p["weight"],
            F.lit(',"height":'), p["height"], city, F.lit(',"caption":"'), p["caption"], F.lit(r' said \"]\u00e9, {'),
            F.lit('","gender":'), p["gender"])
    country = F.concat(F.lit(',"country":'), F.col("c_nationkey"))
    place = F.concat(F.lit(',"location":{"lon":'), (key * 37) % 361 - 180, F.lit(',"lat":'),
                     (key * 17) % 181 - 90, F.lit("}"))
    good = F.concat(head, country, place, F.lit("}"))
    kind = key % 13
    value = (
        F.when(kind == 1, F.concat(head, F.lit(',"country":"5"'), place, F.lit("}")))
        .when(kind == 2, F.concat(head, F.lit(',"country":5.7'), place, F.lit("}")))
        .when(kind == 3, F.concat(head, country, F.lit(',"extra":1'), place, F.lit("}")))
        .when(kind == 4, F.concat(head, country, F.lit(',"location":{"lon":1.5,"alt":7}}')))
        .when(kind == 5, F.concat(bare, F.lit("}")))
        .when(kind == 6, F.lit("not json"))
        .when(kind == 7, F.lit("[1]"))
        .when(kind == 8, F.concat(head, country, F.lit(',"city":5}')))
        .when(kind == 9, F.concat(F.lit("\t"), good, F.lit(" \n")))
        .when(kind == 10, F.concat(good, F.lit(' {"id":2}')))
        .when(kind == 11, F.regexp_replace(F.regexp_replace(good, '"id"', '"ID"'), '"lon"', '"Lon"'))
        .when(kind == 12, F.concat(good, F.lit(" x}")))
        .otherwise(good)
    )
    return customer.select(key.alias("key"), value.alias("value"))


DECODED_SQL = """
select c_custkey as id, c_name as nickname,
       cast(case c_custkey % 13 when 5 then {absent} else c_nationkey end as integer) as country,
       cast(case c_custkey % 13 when 4 then 1.5 when 5 then null
            else (c_custkey * 37) % 361 - 180 end as double) as lon,
       cast(case c_custkey % 13 when 4 then 0 when 5 then null
            else (c_custkey * 17) % 181 - 90 end as double) as lat
from customer where c_custkey % 13 not in ({refused})
"""
LENIENT_SQL = DECODED_SQL.format(absent="0", refused="1, 2, 6, 7, 8, 10, 12")
STRICT_SQL = DECODED_SQL.format(absent="null", refused="1, 2, 3, 4, 6, 7, 8, 11")

WHOLE_SQL = f"""
select d.*, case k when 5 then null else p.email end as email, case k when 5 then null else p.dob end as dob,
       case k when 5 then null else p.weight end as weight, case k when 5 then null else p.height end as height,
       case k when 5 then null else p.city end as city, case k when 5 then null else p.caption || ' said "]é, {{{{' end as caption,
       case k when 5 then null else p.gender end as gender
from ({{decoded}}) d join (select *, id % 13 as k from ({PROFILE_SQL})) p using (id)"""
