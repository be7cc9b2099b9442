WITH b AS (
  SELECT o.o_orderkey AS k, CAST(o.o_orderdate AS DATE) AS d0, r.r_name AS pt
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
), l AS (
  SELECT k, d0, pt,
    CASE WHEN k % 4 = 0 THEN NULL ELSE d0 - CAST(k % 11 - 1 AS INT) END AS onsetdate,
    CASE WHEN k % 3 = 0 THEN NULL ELSE d0 - CAST(k % 4 AS INT) END AS earliestlabcollectiondate,
    CASE WHEN k % 7 = 0 THEN NULL ELSE d0 + CAST(k % 3 AS INT) END AS earliestlabtestresultdate,
    CASE WHEN k % 23 = 0 THEN NULL ELSE CAST((k * 7) % 120 - 2 AS INT) END AS age
  FROM b
)
SELECT
  concat('48-', lpad(CAST(k AS VARCHAR(20)), 7, '0')) AS phacid,
  pt, CAST(k AS VARCHAR(20)) AS ptcaseid, k,
  CASE WHEN k % 10 < 6 THEN 'Confirmed' WHEN k % 10 < 9 THEN 'Probable' ELSE 'Suspect' END AS classification,
  CASE WHEN k % 50 = 0 THEN NULL ELSE d0 + CAST(k % 5 AS INT) END AS phacreporteddate,
  CASE WHEN k % 17 = 0 THEN NULL ELSE d0 END AS reporteddate,
  onsetdate, earliestlabcollectiondate, earliestlabtestresultdate,
  COALESCE(onsetdate, earliestlabcollectiondate, earliestlabtestresultdate) AS episodedate,
  age, CASE WHEN k % 19 = 0 THEN '' WHEN k % 29 = 0 THEN NULL ELSE 'years' END AS ageunit,
  CASE WHEN age IS NULL OR k % 31 = 0 THEN 'Unknown' WHEN age <= 19 THEN '0-19' WHEN age <= 39 THEN '20-39'
       WHEN age <= 59 THEN '40-59' WHEN age <= 79 THEN '60-79' ELSE '80+' END AS agegroup20,
  CASE WHEN age IS NULL OR k % 43 = 0 THEN 'Unknown' WHEN age <= 19 THEN '0-19' WHEN age <= 29 THEN '20-29'
       WHEN age <= 39 THEN '30-39' WHEN age <= 49 THEN '40-49' WHEN age <= 59 THEN '50-59'
       WHEN age <= 69 THEN '60-69' WHEN age <= 79 THEN '70-79' ELSE '80+' END AS agegroup10,
  CASE k % 5 WHEN 0 THEN 'male' WHEN 1 THEN 'FEMALE' WHEN 2 THEN ' other ' WHEN 3 THEN '' ELSE NULL END AS sex,
  CASE k % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'No' WHEN 2 THEN 'unknown' WHEN 3 THEN '' ELSE 'no' END AS asymptomatic,
  CASE k % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN 'unknown' WHEN 3 THEN NULL WHEN 4 THEN '.' ELSE 'NO' END AS symcough,
  CASE k % 7 WHEN 0 THEN 'yes' WHEN 1 THEN 'y' WHEN 2 THEN '' ELSE 'no' END AS symfever,
  CASE k % 8 WHEN 0 THEN 'yes' WHEN 1 THEN 'unknown' ELSE 'no' END AS symother,
  CASE WHEN k % 8 = 0 THEN 'loss of taste' ELSE NULL END AS symotherspec,
  CASE k % 9 WHEN 0 THEN 'yes' WHEN 1 THEN '' ELSE 'no' END AS rfdiabetes,
  CASE k % 11 WHEN 0 THEN 'yes' WHEN 1 THEN NULL ELSE 'no' END AS rfcardiacdisease,
  CASE k % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN 'unknown' ELSE NULL END AS hosp,
  CASE WHEN k % 6 = 0 THEN d0 + 1 ELSE NULL END AS hospstartdate,
  CASE WHEN k % 12 = 0 THEN d0 + 9 ELSE NULL END AS hospenddate,
  CASE k % 13 WHEN 0 THEN 'yes' WHEN 1 THEN '' ELSE 'no' END AS icu,
  CASE WHEN k % 26 = 0 THEN d0 + 2 ELSE NULL END AS icustartdate,
  CASE WHEN k % 39 = 0 THEN d0 + 8 ELSE NULL END AS icuenddate,
  CASE k % 27 WHEN 0 THEN 'yes' ELSE 'no' END AS mechanicalvent,
  CASE WHEN k % 54 = 0 THEN d0 + 3 ELSE NULL END AS ventstartdate,
  CASE WHEN k % 81 = 0 THEN d0 + 7 ELSE NULL END AS ventenddate,
  CASE k % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' ELSE 'unknown' END AS isolation,
  CASE WHEN k % 5 = 0 THEN d0 ELSE NULL END AS isolationstartdate,
  CASE WHEN k % 10 = 0 THEN d0 + 14 ELSE NULL END AS isolationenddate,
  CASE k % 10 WHEN 0 THEN 'ill' WHEN 1 THEN 'Self isolation' WHEN 2 THEN 'Stable' WHEN 3 THEN 'Not reported'
       WHEN 4 THEN 'Other' WHEN 5 THEN 'Pending' WHEN 6 THEN '' WHEN 7 THEN 'Deceased' ELSE 'Recovered' END AS disposition,
  CASE WHEN k % 37 = 0 THEN d0 + CAST(k % 20 - 5 AS INT) ELSE NULL END AS deathdate,
  CASE WHEN k % 13 = 0 THEN d0 + CAST(k % 30 - 4 AS INT) ELSE NULL END AS recoverydate,
  CASE WHEN k % 20 = 7 THEN 'yes' WHEN k % 41 = 0 THEN 'YES' ELSE 'no' END AS coviddeath,
  CASE k % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'Unknown' ELSE NULL END AS travel,
  CASE WHEN k % 9 = 0 THEN 'canada' WHEN k % 9 < 3 THEN 'France' ELSE NULL END AS travelfromcountry1,
  CASE WHEN k % 15 = 0 THEN 'U.S.A.' WHEN k % 9 = 1 THEN 'france' ELSE NULL END AS traveltocountry1,
  CASE WHEN k % 6 < 2 THEN d0 - CAST(k % 25 AS INT) ELSE NULL END AS travelstartdate1,
  CASE WHEN k % 8 < 2 THEN d0 - CAST(k % 9 AS INT) ELSE NULL END AS travelenddate1,
  CASE k % 4 WHEN 0 THEN 'International travel' WHEN 1 THEN 'Domestic - contact' WHEN 2 THEN 'domestic: unknown' ELSE '' END AS exposure_cat,
  CASE k % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE NULL END AS closecontactcase,
  CASE WHEN k % 14 = 0 THEN 'household' ELSE NULL END AS closecontactcasespec,
  CASE WHEN k % 5 = 0 THEN 'Contact of a case' ELSE 'Symptoms' END AS testingreason,
  CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'Canadian resident' ELSE 'Foreign' END AS residency,
  CASE k % 5 WHEN 0 THEN 'Canada' WHEN 1 THEN 'France' ELSE '' END AS residencecountry,
  CASE k % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE NULL END AS indigenous,
  CASE k % 16 WHEN 0 THEN 'First-Nation' WHEN 1 THEN 'inuit' ELSE '' END AS indigenousgroup,
  CASE k % 6 WHEN 0 THEN 'nurse,  RN' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'Teacher (k-12)' END AS occupationspec,
  CASE k % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN 'maybe' ELSE NULL END AS healthcare_worker,
  CASE k % 5 WHEN 0 THEN 'YES' WHEN 1 THEN 'no' WHEN 2 THEN '?' ELSE '' END AS ltc_resident
FROM l
