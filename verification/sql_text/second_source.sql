SELECT phacid, pt, ptcaseid, k, classification, phacreporteddate,
       CASE WHEN k % 61 = 0 THEN reporteddate + 1 ELSE reporteddate END AS reporteddate,
       onsetdate, episodedate, age, agegroup20,
       CASE WHEN k % 59 = 0 THEN 'not collected' ELSE sex END AS sex,
       CASE WHEN k % 53 = 0 THEN 'unknown' ELSE disposition END AS disposition,
       symcough, symfever, coviddeath
FROM cases_fixture
WHERE k % 101 <> 0
