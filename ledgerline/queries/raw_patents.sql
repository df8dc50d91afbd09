SELECT
  CASE WHEN k % 41 = 0 THEN NULL WHEN k % 43 = 0 THEN '  '
       WHEN k % 11 = 0 THEN concat('P', CAST(k - 1 AS STRING))
       WHEN k % 23 = 0 THEN concat('p', CAST(k - 2 AS STRING))
       ELSE concat('P', CAST(k AS STRING)) END AS id,
  concat(' ', c_name, ' ') AS title,
  'P' AS type,
  CASE k % 5 WHEN 0 THEN '外观设计' WHEN 1 THEN '发明专利' ELSE '实用新型' END AS patenttype,
  CASE o_orderstatus WHEN 'F' THEN '授权' WHEN 'O' THEN '公开' ELSE '未知' END AS legalstatus,
  CASE k % 13 WHEN 0 THEN '0' WHEN 1 THEN '' WHEN 2 THEN ' 0 ' WHEN 3 THEN NULL WHEN 4 THEN '2' ELSE '1' END AS hasfulltext,
  CASE k % 17 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN concat('pdf/files/', CAST(k AS STRING), '.pdf')
       ELSE concat('files/', CAST(k AS STRING), '.pdf') END AS publish_file,
  concat(c_name, ' , ', c_mktsegment, ' ;x') AS applicant,
  CASE WHEN k % 2 = 0 THEN concat(CAST(100000 + k % 1000 AS STRING), ' ', n_name) ELSE n_name END AS applicantaddress,
  CASE c_nationkey % 6 WHEN 0 THEN 'CN' WHEN 1 THEN 'WO' WHEN 2 THEN 'HK' WHEN 3 THEN 'us' WHEN 4 THEN NULL ELSE 'ZZ' END AS countryorganization,
  CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN concat(n_name, ';X') ELSE n_name END AS applicantarea,
  CASE k % 3 WHEN 0 THEN concat('cn', CAST(k AS STRING)) WHEN 1 THEN ' CN ' ELSE concat(' us', CAST(k AS STRING), '.x ') END AS patentcode,
  CASE k % 10
    WHEN 0 THEN d
    WHEN 1 THEN replace(d, '-', '')
    WHEN 2 THEN replace(d, '-', '/')
    WHEN 3 THEN concat(d, 'T08:09:10')
    WHEN 4 THEN concat(substring(d, 1, 5), CAST(CAST(substring(d, 6, 2) AS INT) AS STRING), '-', CAST(CAST(substring(d, 9, 2) AS INT) AS STRING))
    WHEN 5 THEN concat(substring(d, 1, 5), CAST(CAST(substring(d, 6, 2) AS INT) AS STRING), '/', CAST(CAST(substring(d, 9, 2) AS INT) AS STRING), ' 8:05:00')
    WHEN 6 THEN CAST(1000000000 + k * 3600 AS STRING)
    WHEN 7 THEN CAST((1000000000 + k * 3600) * 1000 AS STRING)
    WHEN 8 THEN '0000-00-00'
    ELSE CASE WHEN k % 20 = 9 THEN '20240231' ELSE concat(' ', d, ' ') END END AS applicationdate,
  concat(substring(d, 1, 4), '年') AS applicationyear,
  CASE WHEN k % 6 = 0 THEN '  ' ELSE concat(' cn', CAST(k AS STRING), 'a') END AS publicationno,
  CASE k % 3 WHEN 0 THEN d WHEN 1 THEN 'n/a' ELSE replace(d, '-', '') END AS publicationdate,
  substring(d, 1, 4) AS publishyear,
  CASE k % 3 WHEN 0 THEN 'A01B1/00, A01B3/00　; G06F' WHEN 1 THEN ' ' ELSE 'H04L;H04W' END AS classcodelist,
  CASE k % 4 WHEN 0 THEN 'A01B1/00' WHEN 1 THEN ' G0' WHEN 2 THEN '' ELSE NULL END AS mainclasscode,
  CASE k % 8
    WHEN 0 THEN 'A^农业>A01^农林>A01B^整地$$$A^农业>A01^农林$$$G^物理'
    WHEN 1 THEN 'G06F^计算$$$A01B^整地>x$$$G06N^计算模型'
    WHEN 2 THEN ' E05B^锁 $$$ $$$E05C^门闩>y '
    WHEN 3 THEN '>abc$$$^x>y$$$>abc>d'
    WHEN 4 THEN 'H04^通信>H04L'
    WHEN 5 THEN '' WHEN 6 THEN NULL ELSE 'plain' END AS mainclassname,
  concat('agency', CAST(k % 7 AS STRING)) AS agency,
  CASE k % 4 WHEN 0 THEN 'x, y%z ; w' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'q' END AS agent,
  CASE k % 3 WHEN 0 THEN 'i1 , i2' WHEN 1 THEN ' ' ELSE 'i3;i4' END AS inventor,
  concat('abs ', o_orderpriority) AS abstract,
  CASE k % 6 WHEN 0 THEN '12.0' WHEN 1 THEN ' 007.00 ' WHEN 2 THEN '5' WHEN 3 THEN '1.5' WHEN 4 THEN '' ELSE NULL END AS signoryitem,
  CASE k % 2 WHEN 0 THEN '有效' ELSE '失效' END AS validity,
  CASE k % 5 WHEN 0 THEN 'zho' WHEN 1 THEN 'chi' WHEN 2 THEN 'eng' WHEN 3 THEN 'xxx' ELSE NULL END AS language,
  CAST(NULL AS STRING) AS prioritylist,
  CAST(k % 30 AS STRING) AS citedcount,
  CAST(NULL AS STRING) AS pdf_url,
  CASE WHEN k % 9 = 0 THEN 'loader' ELSE NULL END AS created_by,
  CAST(NULL AS STRING) AS updated_by,
  CASE WHEN k % 10 < 8 THEN 'batch_1' ELSE 'batch_2' END AS batch_id,
  file AS _source_file,
  {numbers}
FROM {rows} b
