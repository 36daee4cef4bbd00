"""What the queries have to give: the fixed limits, lists and texts of the checks.

They are stated here a second time, apart from the library, so that a slip in one place shows.
"""

OUTLIER_COLUMNS = ['fare_amount',
 'trip_distance',
 'passenger_count',
 'tip_amount',
 'tolls_amount',
 'total_amount',
 'extra']
AMOUNT_PARTS = ['fare_amount',
 'extra',
 'mta_tax',
 'tip_amount',
 'tolls_amount',
 'improvement_surcharge',
 'congestion_surcharge',
 'Airport_fee']
NEVER_NULL = ['VendorID',
 'tpep_pickup_datetime',
 'tpep_dropoff_datetime',
 'fare_amount',
 'total_amount',
 'trip_distance']
RANGES = [('fare_amount', 0.01, 5000, 1.0, 'Fare must be between $0.01 and $5000'),
 ('total_amount', 0.01, 5000, 1.0, 'Total amount must be between $0.01 and $5000'),
 ('trip_distance', 0, 500, 1.0, 'Trip distance must be between 0 and 500 miles'),
 ('tip_amount', 0, 500, 1.0, 'Tip amount must be between $0 and $500'),
 ('tolls_amount', 0, 200, 1.0, 'Tolls must be between $0 and $200'),
 ('passenger_count',
  1,
  6,
  0.95,
  'Passenger count must be 1-6 (NYC legal limit), allowing 5% for nulls')]
VALUE_SETS = [('VendorID', [1, 2, 6], 1.0, 'VendorID must be 1 (CMT), 2 (VeriFone), or 6'),
 ('payment_type', [0, 1, 2, 3, 4], 1.0, 'Payment type must be 0-4 per NYC TLC data dictionary'),
 ('store_and_fwd_flag', ['Y', 'N'], 0.95, 'store_and_fwd_flag must be Y or N')]
KEY_COLUMNS = ['VendorID', 'tpep_pickup_datetime', 'trip_distance']
CATEGORIES = ['VendorID', 'payment_type', 'RatecodeID']
ISSUE_DEFAULTS = {'issue': 'Unknown',
 'column': 'N/A',
 'severity': 'N/A',
 'violation_count': '0',
 'what_happened': '',
 'likely_cause': '',
 'business_impact': '',
 'recommended_action': ''}
NOT_ONE_OBJECT = "response is not one JSON object"
NOT_A_LIST = "explanations is not a list of objects"

# Lines of the findings text, with the fields that fill them: n, d whole numbers with and
# without separators, f decimals, s text, S text in capitals.
OVERVIEW_LINES = (('DATASET OVERVIEW',),
 ('----------------',),
 ('Name         : %s', 's:dataset_name'),
 ('Rows         : %s', 'n:row_count'),
 ('Columns      : %s', 'd:column_count'),
 ('Profiled at  : %s', 's:profiled_at'),
 ('Health score : %s / 100  (Grade %s)', 'f:score', 's:grade'),
 ('',))
NULL_LINES = (('NULL PROFILE',),
 ('------------',),
 ('Columns with nulls : %s', 'd:columns_with_nulls'),
 ('Total null cells   : %s', 'n:total_null_cells'),
 ('',))
DUPLICATE_LINES = (('DUPLICATE PROFILE',),
 ('-----------------',),
 ('Full duplicates    : %s', 'n:full_duplicates'),
 ('Key-column dupes   : %s  (%s%%)', 'n:key_column_dupes', 'f:key_dupe_pct'),
 ('',))
OUTLIER_LINES = (('OUTLIER PROFILE (IQR method)',),
 ('-----------------------------',),
 ('Columns with severe outliers : %s', 'd:columns_severe'))
SEVERE_OUTLIER_LINES = (('  %s: %s outliers (%s%%)  actual range [%s → %s]  expected [%s → %s]',
  's:column_name',
  'n:total_outliers',
  'f:outlier_pct',
  'f:actual_min',
  'f:actual_max',
  'f:lower_fence',
  'f:upper_fence'),)
RULE_LINES = (('',),
 ('BUSINESS RULE VIOLATIONS',),
 ('-------------------------',),
 ('Rules checked : %s', 'd:rules_checked'),
 ('Rules passed  : %s', 'd:rules_passed'),
 ('Rules failed  : %s', 'd:rules_failed'))
FAILED_RULE_LINES = (('  FAILED: %s', 's:rule_name'),
 ('    Rule       : %s', 's:rule'),
 ('    Violations : %s  (%s%%)', 'n:violations', 'f:violation_pct'),
 ('    Severity   : %s', 'S:severity'))
VALIDATION_LINES = (('',),
 ('GREAT EXPECTATIONS VALIDATION',),
 ('------------------------------',),
 ('Expectations run  : %s', 'd:total'),
 ('Passed            : %s', 'd:passed'),
 ('Failed            : %s', 'd:failed'),
 ('Success rate      : %s%%', 'f:success_pct'))
FAILED_EXPECTATION_LINES = (('  FAILED: %s on [%s]', 's:expectation', 's:column'),
 ('    Violations : %s  (%s%%)', 'n:violation_count', 'f:violation_pct'),
 ('    Rule desc  : %s', 's:description'))
