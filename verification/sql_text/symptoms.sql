SELECT concat('48-', lpad(CAST(l_orderkey AS VARCHAR(20)), 7, '0')) AS phacid,
       l_linenumber AS symptomid,
       CASE l_returnflag WHEN 'A' THEN 'yes' WHEN 'N' THEN 'no' ELSE 'unknown' END AS symptomvalue
FROM lineitem
