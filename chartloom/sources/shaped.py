"""FHIR documents built from the star-schema tables, as inputs for the operators.

Every builder returns a DataFrame whose column `value` is the JSON text of one resource.
Absent elements stay absent in the JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ISO = "yyyy-MM-dd''T''HH:mm:ss''Z''"

PATIENT = """
named_struct(
  'resourceType', 'Patient',
  'id', concat('pat-', k),
  'meta', named_struct(
    'versionId', if(k % 50 = 0, null, string(1 + k % 3)),
    'lastUpdated', concat('2024-01-', lpad(string(1 + k % 28), 2, '0'), 'T00:00:00Z'),
    'profile', array('urn:profile:patient')),
  'identifier', filter(array(
    if(k % 4 <> 0, named_struct('use', string(null), 'type', null, 'system', 'urn:Source',
       'value', c_mktsegment, 'period', null, 'assigner', null), null),
    named_struct('use', 'usual', 'type', named_struct('text', 'MR'), 'system', 'urn:custkey',
       'value', string(k),
       'period', named_struct('start', '2020-01-01', 'end', if(k % 2 = 0, '2021-06', null)),
       'assigner', named_struct('display', 'registry'))), i -> i is not null),
  'active', c_acctbal >= 0,
  'name', filter(array(
    named_struct('use', 'official', 'family', c_name, 'given', array(concat('G', k % 10), 'H'),
       'prefix', if(k % 5 = 0, array('Dr'), null)),
    if(k % 2 = 0, named_struct('use', 'nickname', 'family', null, 'given', array('N'),
       'prefix', null), null)), n -> n is not null),
  'telecom', filter(array(
    named_struct('system', 'phone', 'value', concat('tel-', k), 'rank', int(1 + k % 3)),
    if(k % 3 = 0, named_struct('system', 'email', 'value', concat('mail-', k), 'rank', null), null),
    if(k % 7 = 0, named_struct('system', null, 'value', null, 'rank', null), null)),
    t -> t is not null),
  'gender', if(k % 2 = 0, 'female', 'male'),
  'birthDate', case k % 3
    when 0 then concat(1940 + k % 60, '-', lpad(string(1 + k % 12), 2, '0'), '-',
                       lpad(string(1 + k % 28), 2, '0'))
    when 1 then concat(1940 + k % 60, '-', lpad(string(1 + k % 12), 2, '0'))
    else string(1940 + k % 60) end,
  'address', if(k % 10 = 9, null, array(named_struct(
    'use', 'home',
    'line', if(k % 3 = 0, array(concat(k % 100, ' Main St'), concat('Apt ', k % 7)),
               array(concat(k % 100, ' Main St'))),
    'city', concat('City ', c_nationkey),
    'postalCode', if(k % 8 = 0, null, lpad(string(k % 200), 5, '0')),
    'country', string(c_nationkey)))),
  'maritalStatus', named_struct(
    'coding', case k % 6
      when 0 then array()
      when 1 then null
      else array(named_struct('system', 'urn:segment', 'code', c_mktsegment,
                              'display', lower(c_mktsegment))) end,
    'text', c_mktsegment),
  'multipleBirthInteger', if(k % 20 = 0, int(k % 3), null),
  'contact', if(k % 4 = 0, array(named_struct('name', named_struct('family', concat('C', k)))), null),
  'communication', array(named_struct('language', named_struct('text', 'en'), 'preferred', true)),
  'generalPractitioner', filter(array(
    named_struct('reference', concat('Practitioner/', k % 40), 'identifier', null,
       'display', concat('Dr ', k % 40)),
    if(k % 2 = 0, named_struct('reference', string(null), 'identifier',
       named_struct('system', 'urn:npi', 'value', string(k % 17)), 'display', null), null)),
    r -> r is not null),
  'managingOrganization', named_struct('reference', concat('Organization/nation-', c_nationkey),
     'type', 'Organization'),
  'extension', filter(array(
    named_struct('url', 'urn:ext:group', 'valueCoding', named_struct('code', concat('g', k % 5),
       'display', concat('Group ', k % 5)), 'extension', null),
    if(k % 3 = 0, named_struct('url', 'urn:ext:nested', 'valueCoding', null, 'extension',
       array(named_struct('url', 'inner', 'valueCoding',
         named_struct('display', concat('Inner ', k % 4))))), null)), e -> e is not null)
)"""

ENCOUNTER = f"""
named_struct(
  'resourceType', 'Encounter',
  'id', concat('enc-', k),
  'meta', named_struct('versionId', string(1 + k % 2),
                       'lastUpdated', date_format(o_orderdate, '{ISO}')),
  'identifier', array(named_struct('system', 'urn:enc', 'value', string(k))),
  'status', case o_orderstatus when 'F' then 'finished' when 'O' then 'in-progress'
                               else 'planned' end,
  'class', named_struct('system', 'urn:class', 'code', o_orderstatus,
                        'display', concat('class ', o_orderstatus), 'userSelected', k % 2 = 0),
  'type', case k % 3
    when 0 then null
    when 1 then array(named_struct('coding', array(named_struct('system', 'urn:type', 'code', 'T1',
      'display', 'one', 'extension', null)), 'text', null, 'extension', null))
    else array(
      named_struct('coding', array(named_struct('system', 'urn:type', 'code', 'T1', 'display', 'one',
        'extension', array(named_struct('url', 'urn:c')))), 'text', null, 'extension', null),
      named_struct('coding', array(
        named_struct('system', 'urn:type', 'code', 'T2A', 'display', 'two a',
          'extension', if(k % 2 = 0, array(named_struct('url', 'urn:c')), null)),
        named_struct('system', 'urn:type', 'code', 'T2B', 'display', null, 'extension', null)),
        'text', 'two', 'extension', array(named_struct('url', 'urn:e')))) end,
  'priority', named_struct('text', o_orderpriority),
  'subject', named_struct('reference', concat('Patient/pat-', o_custkey),
                          'display', concat('customer ', o_custkey)),
  'participant', if(k % 4 = 3, null, array(named_struct(
    'type', array(named_struct('coding', array(named_struct('code', 'L', 'display',
       concat('lead ', k % 3))))),
    'individual', named_struct('reference', concat('Practitioner/', k % 40))))),
  'period', named_struct('start', date_format(o_orderdate, '{ISO}'),
                         'end', date_format(o_orderdate + interval 1 day, '{ISO}')),
  'length', named_struct('value', o_totalprice, 'unit', 'min'),
  'hospitalization', if(k % 5 = 0, named_struct(
    'origin', named_struct('reference', concat('Location/', k % 50)),
    'dischargeDisposition', named_struct('text', 'home')), null),
  'location', array(named_struct('location', named_struct(
    'reference', concat('Location/', k % 50), 'display', concat('Ward ', k % 50)),
    'status', 'active')),
  'serviceProvider', named_struct('reference', concat('Organization/org-', k % 30))
)"""

OBSERVATION = f"""
named_struct(
  'resourceType', 'Observation',
  'id', concat('obs-', k),
  'meta', named_struct('versionId', string(1 + k % 4), 'lastUpdated', date_format(ts, '{ISO}')),
  'status', 'final',
  'category', array(named_struct('coding', array(named_struct('code', 'exam')))),
  'code', named_struct(
    'coding', array(named_struct('system', 'urn:event', 'code', event_type,
                                 'display', concat('event ', event_type)),
                    named_struct('system', 'urn:event', 'code', upper(event_type), 'display', null)),
    'text', event_type),
  'subject', named_struct('reference', concat('Patient/pat-', user_id)),
  'encounter', named_struct('reference', concat('Encounter/enc-', k % 1000)),
  'effectiveDateTime', case k % 3
    when 0 then date_format(ts, '{ISO}')
    when 1 then concat(date_format(ts + interval 1 hour, 'yyyy-MM-dd''T''HH:mm:ss'), '+01:00')
    else date_format(ts, 'yyyy/MM/dd') end,
  'valueQuantity', if(k % 10 = 0, null, named_struct('value', value, 'unit', concat('u', k % 3),
                                                     'system', 'urn:unit')),
  'note', case k % 4
    when 0 then array(named_struct('text', ''), named_struct('text', concat('note ', k % 9)))
    when 1 then array(named_struct('text', concat('first ', k % 9)))
    else null end,
  'component', if(k % 5 = 0, array(named_struct('code', named_struct('text', 'part'),
     'valueQuantity', named_struct('value', value))), null),
  'extension', array(named_struct('url', 'urn:props', 'valueString', props))
)"""

CONDITION = f"""
named_struct(
  'resourceType', 'Condition',
  'id', concat('cond-', k),
  'clinicalStatus', named_struct('coding', array(named_struct('code', 'active'))),
  'code', named_struct('coding', array(named_struct('system', 'urn:err',
     'code', concat('E', k % 12))), 'text', concat('error ', k % 12)),
  'subject', named_struct('reference', concat('Patient/pat-', user_id)),
  'onsetDateTime', date_format(ts, '{ISO}')
)"""

# resource type -> (table, key column, row condition, document expression)
SHAPES = {
    "Patient": ("customer", "c_custkey", None, PATIENT),
    "Encounter": ("orders", "o_orderkey", None, ENCOUNTER),
    "Observation": ("events", "event_id", None, OBSERVATION),
    "Condition": ("events", "event_id", "event_type = 'error'", CONDITION),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a scan that has fewer partitions than there are cores.

    Parsing documents costs far more than reading them, so a table in one small file would
    keep a single core busy. A larger table has enough partitions and is not shuffled.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if rows.rdd.getNumPartitions() < cores else rows


def documents(
    spark: SparkSession, sf_dir: str, resource: str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One JSON document per base row of the resource type.

    `keep` carries base columns along; the key column is called `k`.
    """
    source, key, condition, expression = SHAPES[resource]
    rows = spread(table(spark, sf_dir, source), key)
    if condition:
        rows = rows.where(condition)
    return rows.withColumnRenamed(key, "k").selectExpr(*keep, f"to_json({expression}) as value")
