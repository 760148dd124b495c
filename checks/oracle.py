"""DuckDB SQL for the queries: each string states a query's result independently of the library."""

from __future__ import annotations

import re

ADD_DATE, NEW_DATE = "2019-03-13 21:13:08", "2019-03-14 21:13:08"

_VIEWS = {
    "fx_part": """
select p_partkey pk, 'P' || lpad(cast(p_partkey as varchar), 10, '0') code, cast(substr(p_brand, 7) as int) bn,
       p_name, p_brand, p_size, p_retailprice, p_name || ' ' || p_brand label,
       replace(p_name, ' ', '') || cast(p_partkey % 50 as varchar) stem, text
from part left join documents on doc_id = p_partkey""",
    "fx_live_categories": """
select r_regionkey + 1 categories_id, 0 parent_id, r_name categories_description, 1 categories_status, false edited
from region
union all
select 100 + n_nationkey, n_regionkey + 1, n_name, case when n_nationkey % 6 = 0 then 0 else 1 end, n_nationkey % 8 = 3
from nation where n_nationkey % 9 <> 4
union all
select distinct 1000 + bn * 10 + p_size % 6, 100 + bn % 25,
       p_brand || ' size class ' || cast(p_size % 6 as varchar), 1, (bn + p_size % 6) % 5 = 0
from fx_part where (bn + p_size % 6) % 7 <> 0""",
    "fx_feed_categories": """
select r_name dept_name, r_regionkey + 1 dept_code, 1 dept_deep, 1 dept_show, 0 parent_id
from region where r_regionkey <> 4
union all
select case when n_nationkey % 5 = 2 then n_name || ' renamed and padded past thirty-two chars' else n_name end,
       100 + n_nationkey, 2, case when n_nationkey % 6 in (0, 1) then 0 else 1 end,
       case when n_nationkey % 7 = 5 then (n_regionkey + 1) % 5 + 1 else n_regionkey + 1 end
from nation where n_nationkey % 11 <> 7
union all
select distinct p_brand || case when bn % 6 = 1 then ' size group ' else ' size class ' end || cast(p_size % 6 as varchar),
       1000 + bn * 10 + p_size % 6, 3, case when bn % 8 = 3 then 0 else 1 end,
       case when bn = 9 then 777 else 100 + bn % 25 end
from fx_part where (bn + p_size % 6) % 9 <> 0
union all
select 'sentinel', -1, 0, 1, 0""",
    "fx_live_products": """
select cast(pk + 1 as int) products_id, code products_model,
       lower(left(stem, 2) || '/' || stem || '.jpg') products_image,
       cast(p_retailprice as decimal(15,4)) products_price, cast(p_size as float) products_quantity,
       cast(1 + pk % 7 as float) products_weight, case when pk % 9 = 0 then 0 else 1 end products_status,
       left(label, 64) products_name, coalesce(text, '') products_description, pk % 13 = 0 edited,
       100001 master_categories_id
from fx_part where pk % 10 <> 0""",
    "fx_feed_complete": """
select code prod_code, case when pk % 12 = 5 then label || ' ' || repeat('x', 60) else label end prod_desc,
       case when pk % 14 = 6 then '' else text end narrative,
       cast(case when pk % 8 = 1 then 0 else p_size end as float) units_qty, cast(1 + pk % 7 as float) weight,
       cast(p_retailprice + case when pk % 7 = 2 then 1 else 0 end as decimal(15,4)) price,
       replace(stem, 'r', ' r') || case when pk % 3 = 0 then '.jpeg' else '.jpg' end prod_image,
       case when pk % 15 = 4 then 1 else 0 end cantsell
from fx_part where pk % 11 <> 3""",
    "fx_feed_stock": """
select code prod_code, case when pk % 16 = 7 then label || ' restocked' else label end prod_desc,
       cast(p_size + case when pk % 5 = 1 then 2 else 0 end as float) units_qty,
       cast(1 + pk % 7 + case when pk % 17 = 8 then 1 else 0 end as float) weight,
       cast(p_retailprice + case when pk % 5 = 1 then 2 else 0 end as decimal(15,4)) price, stem || '.jpg' prod_image,
       case when pk % 19 = 9 then 1 else 0 end cantsell
from fx_part where (pk % 6 <> 0 and pk % 11 <> 3) or (pk % 11 = 3 and pk % 3 = 0)""",
    "fx_feed_descriptions": """
select code prod_code,
       case when pk % 18 = 1 then '' else 'About ' || label || '. ' || coalesce(text, '') end narrative
from fx_part where (pk % 4 = 1 and pk % 11 <> 3) or (pk % 11 = 3 and pk % 3 in (0, 1))""",
    "fx_links": """
select pk, code, 1000 + bn * 10 + p_size % 6 cid from fx_part
union
select pk, code, 1000 + ((bn + s_nationkey) % 25 + 1) * 10 + p_size % 6
from lineitem join fx_part on l_partkey = pk join supplier on l_suppkey = s_suppkey
union
select pk, code, 100 + bn % 25 from fx_part where pk % 20 = 0""",
    "fx_feed_links": """
select code prod_code, cast(cid as int) dept_code from fx_links where (pk + cid) % 10 <> 0
union all select code, 99999 from fx_part where pk % 33 = 0
union all select 'X' || code, 1000 + bn * 10 + p_size % 6 from fx_part where pk % 40 = 0""",
    "fx_live_links": """
select cast(pk + 1 as int) products_id, cast(cid as int) categories_id, code products_model
from fx_links where pk % 10 <> 0 and (pk + cid) % 9 <> 0""",
    "fx_placement_log": """
select 100 + bn % 25 categories_id, cast(pk + 1 as int) products_id, 'Non-leaf category placement' issue,
       code products_model, cast(null as varchar) note_1, cast(null as varchar) note_2
from fx_part where pk % 14 = 3""",
    "fx_media": """
select case when v = 2 then 'large z' when v = 3 then 'thumb t' else '' end dir,
       case v when 1 then upper(stem) || '.JPEG' when 2 then stem || '_z.jpg' when 3 then stem || 't.jpg'
              else stem || '_a.jpg' end as name,
       cast(1000 + (pk * 31 + v * 17) % 997 as bigint) length, md5(code || cast(v as varchar)) md5
from fx_part cross join (select 1 v union all select 2 union all select 3 union all select 4) q
where (pk + v) % 5 <> 0""",
    "fx_media_current": """
select lower(left(stem, 2) || '/' || stem || '.jpg') as key,
       cast(min(case when pk % 4 = 0 then 0 else 1000 end) as bigint) length, min(md5(code || '2')) md5
from fx_part where pk % 6 <> 0 group by 1""",
    "fx_snapshots": """
select k, code, cast(p_retailprice + case when (pk + k) % 4 = 0 then k else 0 end as decimal(15,4)) price,
       cast((p_size + k * pk) % 6 as float) qty,
       label || case when (pk + k) % 12 = 5 then ' v' || cast(k as varchar) else '' end descr
from fx_part cross join (select 1 k union all select 2 union all select 3) q where (pk + k) % 10 <> 0""",
    # store tables with rows that must not take part -----------------------
    "mx_categories": """
select categories_id, parent_id, categories_status, edited from fx_live_categories
union all select categories_id + 100001, parent_id, categories_status, edited from fx_live_categories""",
    "mx_categories_description": """
select categories_id, 1 language_id, categories_description from fx_live_categories where categories_id % 10 <> 7
union all
select categories_id, 2, categories_description || ' (2)' from fx_live_categories where categories_id % 3 = 0""",
    "mx_products": """
select products_id, products_model, products_image, products_price, products_quantity, products_weight,
       products_status, edited, master_categories_id
from fx_live_products
union all
select products_id + 500000000, products_model, products_image, products_price, products_quantity, products_weight,
       products_status, edited, master_categories_id
from fx_live_products where products_id % 50 = 1
union all
select products_id + 1000000000, products_model, products_image, products_price, products_quantity, products_weight,
       products_status, edited, master_categories_id
from fx_live_products""",
    "mx_products_description": """
select products_id, 1 language_id, products_name, products_description from fx_live_products
where products_id % 10 <> 7
union all
select products_id, 2, products_name, products_description || ' (2)' from fx_live_products where products_id % 3 = 0""",
    "mx_live_products": """
select * exclude (rank) from (
    select p.products_id, products_model, products_image, products_price, products_quantity, products_weight,
           products_status, edited, master_categories_id, coalesce(products_name, '') products_name,
           coalesce(products_description, '') products_description,
           row_number() over (partition by products_model order by p.products_id) rank
    from mx_products p left join mx_products_description d on p.products_id = d.products_id
    where p.products_id < 1000000000 and (language_id = 1 or language_id is null))
where rank = 1""",
    "mx_links": """
select products_id, categories_id from fx_live_links
union all select products_id + 1000000000, categories_id from fx_live_links
union all select products_id, 100001 from fx_live_products""",
    # category change sets ---------------------------------------------------
    "import_c": """
select dept_code categories_id, parent_id, dept_name categories_description, dept_show categories_status
from fx_feed_categories where dept_code >= 0""",
    "new_c": """
select categories_id, parent_id, left(categories_description, 32) categories_name, categories_description,
       categories_status
from import_c where categories_id not in (select categories_id from fx_live_categories)""",
    "dropped_c": """
select categories_id from fx_live_categories where categories_id not in (select categories_id from import_c)""",
    "both_c": """
select i.categories_id, i.parent_id, i.categories_description, i.categories_status, l.parent_id old_parent,
       l.categories_description old_description, l.categories_status old_status, edited
from import_c i join fx_live_categories l on i.categories_id = l.categories_id""",
    "changed_c": """
select * from both_c
where not (parent_id = old_parent and categories_description = old_description and categories_status = old_status)""",
    "reparented_c": "select categories_id, parent_id from both_c where parent_id <> old_parent",
    "renamed_c": """
select categories_id, left(categories_description, 32) categories_name, categories_description
from both_c where categories_description <> old_description and not edited""",
    "status_c": """
select categories_id, categories_status from both_c where categories_status <> old_status
union all select categories_id, 0 from dropped_c""",
    "known_c": """
select categories_id from fx_live_categories union select categories_id from new_c union select 0""",
    "moved_c": """
select categories_id, parent_id, categories_status from new_c
union all select categories_id, parent_id, categories_status from changed_c""",
    "issues_c": """
select categories_id, 'Name too long' issue, categories_name note_1, categories_description note_2
from new_c where categories_name <> categories_description
union all
select categories_id, 'Invalid parent_id', cast(parent_id as varchar), null
from (select categories_id, parent_id from new_c union all select categories_id, parent_id from fx_live_categories)
where parent_id in (select categories_id from dropped_c) or parent_id not in (select categories_id from known_c)
union all
select c.categories_id, 'Inactive parent', cast(c.parent_id as varchar), null
from moved_c c join moved_c p on c.parent_id = p.categories_id
where c.categories_status = 1 and p.categories_status = 0""",
    "next_c": """
select l.categories_id, coalesce(r.parent_id, l.parent_id) parent_id,
       case when l.categories_id in (1054, 1115, 107) then 0
            else coalesce(s.categories_status, l.categories_status) end categories_status,
       case when edited then timestamp '2019-02-01 00:00:00' end last_modified,
       timestamp '2019-01-01 00:00:00' date_added
from fx_live_categories l left join reparented_c r on l.categories_id = r.categories_id
left join status_c s on l.categories_id = s.categories_id
union all
select categories_id, parent_id, case when categories_id in (1054, 1115, 107) then 0 else 1 end, null,
       timestamp '2019-03-13 21:13:08'
from new_c""",
    # product change sets ----------------------------------------------------
    "codes": """
select prod_code code from fx_feed_complete union select prod_code from fx_feed_stock
union select prod_code from fx_feed_descriptions""",
    "import_p": """
select code products_model,
       lower(left(image, 2) || '/' || image) products_image, price products_price, qty products_quantity,
       weight products_weight, case when cantsell = 1 then 0 else 1 end products_status,
       left(descr, 64) products_name, title products_title, narrative products_description
from (
    select code, replace(replace(replace(
               case when s.prod_code is not null then s.prod_image else c.prod_image end,
               ' ', ''), '.jpeg', '.jpg'), '.tiff', '.tif') image,
           cast(case when s.prod_code is not null then s.price when c.prod_code is not null then c.price
                     else 0 end as decimal(15,4)) price,
           cast(case when s.prod_code is not null then s.units_qty when c.prod_code is not null then c.units_qty
                     else 0 end as float) qty,
           cast(case when s.prod_code is not null then s.weight when c.prod_code is not null then c.weight
                     else 0 end as float) weight,
           case when s.prod_code is not null then s.cantsell when c.prod_code is not null then c.cantsell
                else 1 end cantsell,
           case when s.prod_code is not null then s.prod_desc when c.prod_code is not null then c.prod_desc
                else '' end descr,
           case when s.prod_code is not null then s.prod_desc when c.prod_code is not null then code
                else '' end title,
           case when d.prod_code is not null then d.narrative
                when c.narrative = '' then c.prod_desc else c.narrative end narrative
    from codes left join fx_feed_complete c on code = c.prod_code left join fx_feed_stock s on code = s.prod_code
    left join fx_feed_descriptions d on code = d.prod_code)""",
    "new_p": """
select products_model, products_image, products_price, products_quantity, products_weight,
       case when products_quantity > 0 then products_status else 0 end products_status, products_name, products_title,
       products_description
from import_p where products_model not in (select products_model from fx_live_products)""",
    "numbered_p": """
select cast((select max(products_id) from fx_live_products) + row_number() over (order by products_model) as int)
       products_id, *
from new_p""",
    "both_p": """
select l.products_id, i.*, l.products_price old_price, l.products_quantity old_quantity,
       l.products_weight old_weight, l.products_status old_status, l.products_name old_name,
       l.products_description old_description, edited
from import_p i join fx_live_products l on i.products_model = l.products_model""",
    "dropped_p": """
select products_id from fx_live_products
where products_status = 1 and products_model not in (select products_model from import_p)""",
    "vitals_p": """
select products_id, products_model, nullif(products_quantity, old_quantity) products_quantity,
       nullif(products_weight, old_weight) products_weight, nullif(products_price, old_price) products_price,
       old_price
from both_p
where products_price <> old_price or products_weight <> old_weight or products_quantity <> old_quantity""",
    "inactive_p": """
select products_id from both_p where old_status = 1 and (products_status = 0 or not products_quantity > 0)
union all select products_id from dropped_p""",
    "active_p": """
select products_id from both_p where old_status = 0 and products_status = 1 and products_quantity > 0""",
    "residual_p": """
select * from both_p
where not coalesce(products_name = old_name and products_description = old_description, false)""",
    "info_p": """
select products_id, case when products_name <> old_name then products_name end products_label,
       case when products_name <> old_name then products_title end products_title,
       case when products_description <> old_description then products_description end products_narrative
from residual_p where not edited and (products_name <> old_name or products_description <> old_description)""",
    "issues_p": """
select products_model, 'Name too long' issue, products_name note_1, products_title note_2
from new_p where products_name <> products_title
union all
select products_model, 'Missing Description', null, null from residual_p
where products_description is null or products_description = ''
union all
select products_model, 'Missing Name', null, null from residual_p where products_name is null or products_name = ''""",
    "next_p": """
select l.products_id, l.products_model, l.products_image, coalesce(v.products_price, l.products_price) products_price,
       coalesce(v.products_quantity, l.products_quantity) products_quantity,
       coalesce(v.products_weight, l.products_weight) products_weight,
       case when l.products_id in (select products_id from active_p) then 1
            when l.products_id in (select products_id from inactive_p) then 0
            else l.products_status end products_status,
       100001 master_categories_id, coalesce(v.products_price, v.old_price, l.products_price) products_price_sorter
from fx_live_products l left join vitals_p v on l.products_id = v.products_id
union all
select products_id, products_model, products_image, products_price, products_quantity, products_weight,
       products_status, 100001, products_price
from numbered_p""",
    "next_description": """
select l.products_id, 1 language_id, coalesce(products_label, products_name) products_name,
       coalesce(products_narrative, products_description) products_description
from fx_live_products l left join info_p i on l.products_id = i.products_id
union all select products_id, 1, products_name, products_description from numbered_p""",
    "next_meta": """
select l.products_id, 1 language_id, coalesce(products_title, products_name) metatags_title,
       coalesce(products_narrative, products_description) metatags_keywords,
       coalesce(products_narrative, products_description) metatags_description
from fx_live_products l left join info_p i on l.products_id = i.products_id
union all select products_id, 1, products_title, products_description, products_description from numbered_p""",
    # links --------------------------------------------------------------------
    "import_l": """
select distinct prod_code products_model, dept_code categories_id
from fx_feed_links where dept_code in (select categories_id from next_c)""",
    "resolved_l": """
select i.products_model, i.categories_id, coalesce(l.products_id, n.products_id) products_id,
       n.products_id is not null is_new
from import_l i left join fx_live_products l on i.products_model = l.products_model
left join numbered_p n on i.products_model = n.products_model""",
    "new_l": """
select products_model, categories_id, products_id from resolved_l where is_new
union select products_model, 100001, products_id from numbered_p""",
    "known_l": "select products_id, categories_id from resolved_l where not is_new and products_id is not null",
    "parents": "select distinct parent_id from next_c",
    "dropped_l": """
select products_id, categories_id from fx_live_links
where (products_id, categories_id) not in (select (products_id, categories_id) from known_l)
  and products_id not in (select products_id from fx_placement_log where issue = 'Non-leaf category placement')""",
    "added_l": """
select products_id, categories_id from known_l
where (products_id, categories_id) not in (select (products_id, categories_id) from fx_live_links)
  and categories_id not in (select parent_id from parents)""",
    "next_l": """
select products_id, categories_id from fx_live_links
where (products_id, categories_id) not in (select (products_id, categories_id) from dropped_l)
union all select products_id, categories_id from added_l
union all select products_id, categories_id from new_l""",
    "priority": """
select * from (values (0, 1054), (1, 1234), (2, 1115), (3, 1012), (4, 1200), (5, 1201), (6, 1243), (7, 1193))
    t(rank, cid)""",
    "masters": """
select products_id, coalesce(arg_min(categories_id, rank) filter (where rank is not null), min(categories_id))
       master_categories_id
from next_l left join priority on categories_id = cid
where categories_id <> 100001 group by products_id""",
    "masters_live": """
select products_id, coalesce(arg_min(categories_id, rank) filter (where rank is not null), min(categories_id))
       master_categories_id
from fx_live_links left join priority on categories_id = cid group by products_id""",
    "issues_l": """
select l.categories_id, l.products_id, 'Non-leaf category placement' issue, p.products_model,
       cast(null as varchar) note_1, cast(null as varchar) note_2
from next_l l join next_p p on l.products_id = p.products_id where l.categories_id in (select parent_id from parents)
union all
select 100001, p.products_id, 'No category assigned', p.products_model, d.products_name, null
from next_p p join next_description d on p.products_id = d.products_id
where p.products_id not in (select products_id from masters)
union all
select categories_id, 0, 'Unknown product', products_model, null, null from resolved_l where products_id is null""",
    # media --------------------------------------------------------------------
    "media_parts": """
select *, regexp_replace(folded, '\\.[^.]*$', '') stem,
       replace(replace(regexp_extract(folded, '[^.]*$'), 'jpeg', 'jpg'), 'tiff', 'tif') ext
from (select dir, name, length, md5, lower(replace(name, ' ', '')) folded,
             case dir when 'large z' then 'z' when 'thumb t' then 't' else '' end suffix
      from fx_media)""",
    "media_known": """
select distinct regexp_replace(stem, '_.$', '') stem, ext from media_parts where suffix = ''""",
    "media_keyed": """
select dir, name, length, md5, left(canon, 2) prefix, left(canon, 2) || '/' || canon || '.' || ext as key
from (select p.*, case
        when k.stem is not null then p.stem
        when suffix = '' then regexp_replace(p.stem, '_.$', '')
        when kb.stem is not null then kb.stem
        when ku.stem is not null then ku.stem
        when p.stem like '%\\_' || suffix escape '\\' then left(p.stem, length(p.stem) - 2)
        when p.stem like '%' || suffix then left(p.stem, length(p.stem) - 1)
        else p.stem end canon
      from media_parts p
      left join media_known k on p.stem = k.stem and p.ext = k.ext
      left join media_known kb on suffix <> '' and p.stem = kb.stem || suffix and p.ext = kb.ext
      left join media_known ku on suffix <> '' and p.stem = ku.stem || '_' || suffix and p.ext = ku.ext)""",
    "media_best": """
select key, prefix, dir, name, length, md5
from (select *, row_number() over (partition by key order by length desc, dir desc, name desc, md5) r
      from media_keyed) where r = 1""",
    "media_fresh": """
select b.* from media_best b left join fx_media_current c on b.key = c.key
where c.key is null or c.length = 0 or b.md5 <> c.md5""",
    "media_lost": """
select distinct products_image as key from fx_live_products
where products_image not in (select key from fx_media_current where length > 0)""",
}

_NUMBER = "case when {0} = floor({0}) then cast(cast({0} as bigint) as varchar) else cast({0} as varchar) end"


def _text(column: str) -> str:
    return f"""'"' || replace(replace({column}, '\\', '\\\\'), '"', '\\"') || '"'"""


def _num(column: str) -> str:
    return _NUMBER.format(column)


def _key(*columns: str) -> str:
    return " || '/' || ".join(f"lpad(cast({c} as varchar), 10, '0')" for c in columns)


def _set(column: str, value: str) -> str:
    return f"'`{column}`=' || {value}"


def _int(column: str) -> str:
    return f"cast({column} as varchar)"


def _insert(table: str, *sets: str) -> str:
    return f"'INSERT IGNORE INTO `{table}` SET ' || concat_ws(',', {', '.join(sets)}) || ';'"


def _update(table: str, where: str, *sets: str) -> str:
    return f"'UPDATE `{table}` SET ' || concat_ws(',', {', '.join(sets)}) || ' WHERE ' || {where} || ' LIMIT 1;'"


def _patch(phase: int, step: int, key: str, statement: str, source: str) -> str:
    return f"select {phase} phase, {step} step, {key} sort_key, {statement} statement from {source}"


_CID, _PID = _set("categories_id", _int("categories_id")), _set("products_id", _int("products_id"))
_C_TEXT = [_set(c, _text(c)) for c in ("categories_name", "categories_description")]
_C_META = [
    _set("metatags_title", _text("left(categories_description, 64)")),
    _set("metatags_keywords", _text("categories_description")),
    _set("metatags_description", _text("categories_description")),
]
_C_LANG = _CID + " || ' AND `language_id`=1'"
_C_KEY, _P_KEY = _key("categories_id"), _key("products_id")
_P_META = [
    _set("metatags_title", _text("products_title")),
    _set("metatags_keywords", _text("products_narrative")),
    _set("metatags_description", _text("products_narrative")),
]
_STATUS_LIST = """
select 2 phase, {step} step, lpad(cast(start as varchar), 10, '0') sort_key,
       'UPDATE `products` SET `products_status`={value} WHERE `products_id` IN (' || ids || ');' statement
from (select products_id // 1000 * 1000 as start,
             string_agg(cast(products_id as varchar), ',' order by products_id) ids
      from {source} group by 1)"""

_PATCHES = {
    "categories": [
        _patch(1, 1, _C_KEY, _insert(
            "categories", _CID, _set("parent_id", _int("parent_id")), f"'`date_added`=\"{ADD_DATE}\"'"), "new_c"),
        _patch(1, 2, _C_KEY, _insert("categories_description", _CID, *_C_TEXT), "new_c"),
        _patch(1, 3, _C_KEY, _insert("meta_tags_categories_description", _CID, *_C_META), "new_c"),
        _patch(1, 4, _C_KEY, _update("categories", _CID, _set("parent_id", _int("parent_id"))), "reparented_c"),
        _patch(1, 5, _C_KEY, _update("categories_description", _C_LANG, *_C_TEXT), "renamed_c"),
        _patch(1, 6, _C_KEY, _update("meta_tags_categories_description", _C_LANG, *_C_META), "renamed_c"),
        _patch(1, 7, _C_KEY, _update(
            "categories", _CID, _set("categories_status", _int("categories_status"))),
            "(select s.* from status_c s join fx_live_categories l on s.categories_id = l.categories_id "
            "where s.categories_status <> l.categories_status)"),
        "select 1, 8, '', 'UPDATE `categories` SET `categories_status`=0 WHERE `categories_id` IN (1054,1115,107);'",
    ],
    "status": [
        _STATUS_LIST.format(step=1, value=1, source="active_p"),
        _STATUS_LIST.format(step=2, value=0, source="inactive_p"),
    ],
    "info": [
        _patch(2, 3, _P_KEY, _update(
            "products_description", _PID, _set("products_name", _text("products_label")),
            _set("products_description", _text("products_narrative"))), "info_p"),
        _patch(2, 4, _P_KEY, _update("meta_tags_products_description", _PID, *_P_META), "info_p"),
    ],
    "vitals": [
        _patch(2, 5, _P_KEY, _update(
            "products", _PID, _set("products_quantity", _num("products_quantity")),
            _set("products_weight", _num("products_weight")), _set("products_price", _int("products_price")),
            _set("products_price_sorter", _int("products_price"))), "vitals_p"),
    ],
    "new_products": [
        _patch(2, 6, _P_KEY, _insert(
            "products", _PID, _set("products_quantity", _num("products_quantity")),
            _set("products_model", _text("products_model")), _set("products_image", _text("products_image")),
            _set("products_price", _int("products_price")), f"'`products_date_added`=\"{ADD_DATE}\"'",
            f"'`products_date_available`=\"{NEW_DATE}\"'", _set("products_weight", _num("products_weight")),
            _set("products_status", _int("products_status")), "'`manufacturers_id`=1'",
            _set("products_price_sorter", _int("products_price")), "'`master_categories_id`=100001'"), "numbered_p"),
        _patch(2, 7, _P_KEY, _insert(
            "products_description", _PID, "'`language_id`=1'", _set("products_name", _text("products_name")),
            _set("products_description", _text("products_description"))), "numbered_p"),
        _patch(2, 8, _P_KEY, _insert(
            "meta_tags_products_description", _PID, "'`language_id`=1'",
            *[s.replace("products_narrative", "products_description") for s in _P_META]), "numbered_p"),
    ],
    "links": [
        _patch(3, 1, _key("products_id", "categories_id"),
               f"'DELETE FROM `products_to_categories` WHERE ' || {_PID} || ' AND ' || {_CID} || ';'", "dropped_l"),
        _patch(3, 2, _key("products_id", "categories_id"),
               "'INSERT IGNORE INTO `products_to_categories` (`products_id`,`categories_id`) VALUES (' || products_id "
               "|| ',' || categories_id || ');'", "added_l"),
        _patch(3, 3, "products_model || '/' || " + _key("categories_id"),
               _insert("products_to_categories", _PID, _CID), "new_l"),
        _patch(3, 4, _P_KEY, _update(
            "products", _PID, _set("master_categories_id", _int("master_categories_id"))), "masters"),
    ],
}


def _union(*patches: str) -> str:
    return "\nunion all\n".join(p for name in patches for p in _PATCHES[name])


_CLEAN = "trim(regexp_replace(replace({0}, '\"', '”'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' ')"
_SPICE = " ‘n’ “x” €"

_QUERIES = {
    "live_categories": """
select c.categories_id, parent_id, categories_status, coalesce(categories_description, '') categories_description,
       edited
from mx_categories c left join mx_categories_description d on c.categories_id = d.categories_id
where c.categories_id < 100001 and (language_id = 1 or language_id is null)""",
    "live_products": "select * from mx_live_products",
    "live_links": """
select l.products_id, categories_id, products_model
from mx_links l left join mx_live_products p on l.products_id = p.products_id
where l.products_id < 1000000000 and categories_id < 100001""",
    "seed_control_categories": """
select categories_id, 1 language_id, left(categories_description, 32) categories_name, categories_description
from fx_live_categories
union all select 100001, 1, 'Feed imports', 'Products brought in by the feed'
union all select 100002, 1, 'Feed issues', 'Products with errors found in the feed'""",
    "merge_product_feeds": "select * from import_p",
    "import_categories": "select * from import_c",
    "categories_new": "select * from new_c",
    "categories_dropped": "select * from dropped_c",
    "categories_unchanged": """
select categories_id from both_c where categories_id not in (select categories_id from changed_c)""",
    "categories_reparented": "select * from reparented_c",
    "categories_renamed": "select * from renamed_c",
    "categories_status": "select * from status_c",
    "products_new": "select * from new_p",
    "products_dropped": "select * from dropped_p",
    "products_vitals": "select * exclude (old_price) from vitals_p",
    "products_vitals_laid_out": "select * exclude (old_price) from vitals_p",
    "products_vitals_ranged": """
select prod_code products_model, cast(null as float) products_quantity, cast(null as float) products_weight,
       price + 1 products_price
from fx_feed_stock where cast(substr(prod_code, 2) as bigint) % 40 = 1""",
    "products_vitals_folded": """
with live as (select *, products_model || 'È' model from fx_live_products),
spelled as (
    select prod_code || 'é  ' model, 1 first from fx_feed_complete union all
    select lower(prod_code) || 'E', 2 from fx_feed_stock union all
    select lower(prod_code) || 'Ê ', 3 from fx_feed_descriptions),
shown as (select strip_accents(lower(rtrim(model))) folded, arg_min(model, first) model from spelled group by 1)
select products_id, shown.model products_model, v.products_quantity, v.products_weight, v.products_price
from vitals_p v join live using (products_id) join shown on folded = strip_accents(lower(rtrim(live.model)))""",
    "products_inactive": "select * from inactive_p",
    "products_active": "select * from active_p",
    "products_residual": "select products_id, products_model, products_name, products_description from residual_p",
    "products_info": "select * from info_p",
    "upsert_info": "select * from info_p",
    "import_links": "select * from import_l",
    "links_folded": """
select distinct prod_code products_model, dept_code categories_id, products_id
from fx_feed_links left join fx_live_products on prod_code = products_model
where dept_code in (select categories_id from fx_live_categories)""",
    "links_new": "select * from new_l",
    "links_dropped": "select * from dropped_l",
    "links_added": "select * from added_l",
    "issues_categories": "select * from issues_c",
    "issues_products": "select * from issues_p",
    "issues_links": "select * from issues_l",
    "issues_products_dirty": """
select * from issues_p
union all
select prod_code, 'Duplicate key', cast(most as varchar), null from repeated_p""",
    "run_dirty": """
select products_model, issue from issues_p
union all
select prod_code, 'Duplicate key' from repeated_p
union all
select prod_code, 'Rejected row' from fx_feed_stock
where cast(substr(prod_code, 2) as bigint) % 7 = 0 or cast(substr(prod_code, 2) as bigint) % 11 = 0""",
    "append_issues": """
select prod_code products_model, 'Missing Description' issue, 'seen before' note_1, cast(null as varchar) note_2
from fx_feed_descriptions
union all
select * from issues_p
where not (issue = 'Missing Description' and products_model in (select prod_code from fx_feed_descriptions))""",
    "issue_log_two_runs": """
select prod_code products_model, 'Missing Description' issue, 'seen before' note_1, cast(null as varchar) note_2, 1 run
from fx_feed_descriptions
union all
select *, 2 from issues_p
where not (issue = 'Missing Description' and products_model in (select prod_code from fx_feed_descriptions))""",
    "first_wins": """
select l_partkey, l_shipdate, l_orderkey, l_linenumber, l_quantity
from (select *, row_number() over (partition by l_partkey
             order by l_shipdate, l_orderkey, l_linenumber, l_quantity) r from lineitem) where r = 1""",
    "allocate_ids": "select products_id, products_model from numbered_p",
    "assign_master": "select * from masters_live",
    "apply_categories": "select categories_id, parent_id, categories_status, last_modified, date_added from next_c",
    "apply_category_text": """
select l.categories_id, 1 language_id, coalesce(r.categories_name, left(l.categories_description, 32)) categories_name,
       coalesce(r.categories_description, l.categories_description) categories_description
from fx_live_categories l left join renamed_c r on l.categories_id = r.categories_id
union all select categories_id, 1, categories_name, categories_description from new_c""",
    "apply_category_meta": """
select l.categories_id, 1 language_id,
       left(coalesce(r.categories_description, l.categories_description), 64) metatags_title,
       coalesce(r.categories_description, l.categories_description) metatags_keywords,
       coalesce(r.categories_description, l.categories_description) metatags_description
from fx_live_categories l left join renamed_c r on l.categories_id = r.categories_id
union all
select categories_id, 1, left(categories_description, 64), categories_description, categories_description from new_c""",
    "apply_products": "select * from next_p",
    "apply_product_text": "select * from next_description",
    "apply_product_meta": "select * from next_meta",
    "apply_links": "select * from next_l",
    "patch_categories": _union("categories"),
    "patch_status_list": _union("status"),
    "patch_info": _union("info"),
    "patch_vitals": _union("vitals"),
    "patch_new_products": _union("new_products"),
    "patch_links": _union("links"),
    "run_patch": _union(*_PATCHES),
    "clean_text": f"select doc_id, {_CLEAN.format('text')} as text from documents",
    "media_keys": "select key, prefix, max(length) length from media_keyed group by all",
    "media_keep_largest": "select * from media_best",
    "media_new": "select * from media_fresh",
    "media_missing": "select * from media_lost",
    "media_candidates": "select * from media_found",
    "media_manifest": """
select key, prefix, dir, name, length, md5, 'now' run from media_fresh
union all
select key, left(key, 2), '', split_part(key, '/', 2), length, md5, 'before' from fx_media_current
where key not in (select key from media_fresh)""",
    "changed_sources": """
select cast(page_id as varchar) as name, md5(html) md5
from pages where page_id % 3 = 0 or page_id % 5 = 1""",
    "media_contents": """
select md5(content) md5, strlen(content)::bigint as length, true named
from (select string_agg(html || chr(10), '' order by page_id) content from pages group by page_id % 24)""",
    "changed_files": """
select distinct 'g=' || cast(page_id % 12 as varchar) as name
from pages where page_id % 12 in (5, 7, 9)""",
    "interval_day": "select code prod_code, descr prod_desc, qty units_qty, price from fx_snapshots where k = 2",
    "interval_record": """
select code prod_code, qty units_qty, price, 1 copies, cast(min(k) as int) k, cast(count(*) as int) as "days"
from (select *, k - row_number() over (partition by code, price, qty, descr order by k) run from fx_snapshots)
group by code, price, qty, descr, run""",
    "replay_snapshots": """
select l.products_id, l.products_model, coalesce(s.price, products_price) products_price,
       coalesce(s.qty, products_quantity) products_quantity,
       cast(case when s.code is null then products_weight else 0 end as float) products_weight,
       case when s.k = 3 and s.qty > 0 then 1 else 0 end products_status,
       case when edited then products_name else coalesce(left(s.descr, 64), products_name) end products_name
from fx_live_products l left join last_seen s on products_model = s.code
union all
select cast((select max(products_id) from fx_live_products) + row_number() over (order by first_k, code) as int), code,
       price, qty, cast(0 as float), case when k = 3 and qty > 0 then 1 else 0 end, left(descr, 64)
from last_seen where code not in (select products_model from fx_live_products)""",
    "replay_links": """
select products_id, categories_id from fx_live_links
where (products_id, categories_id) not in (select (products_id, categories_id) from replay_dropped)
union all
select products_id, categories_id from replay_known
where (products_id, categories_id) not in (select (products_id, categories_id) from fx_live_links)
  and categories_id not in (select parent_id from parents)
union all
select products_id, categories_id from import_l join replay_new on products_model = code
union all
select products_id, 100001 from replay_new""",
    # Categories are made active and take the feed's status on the day after.
    "replay_categories": """
select c.categories_id, c.parent_id,
       case when c.categories_id in (1054, 1115, 107) then 0 else coalesce(n.categories_status, c.categories_status) end
       categories_status
from next_c c left join new_c n on c.categories_id = n.categories_id""",
    "run_products": """
select p.* replace (coalesce(m.master_categories_id, p.master_categories_id) as master_categories_id)
from next_p p left join masters m on p.products_id = m.products_id""",
    "run_descriptions": "select * from next_description",
    "run_links": "select * from next_l",
    "run_categories": "select categories_id, parent_id, categories_status, last_modified, date_added from next_c",
    "run_issues_categories": "select * from issues_c",
    "run_issues_products": "select * from issues_p",
    "patch_file": f"select statement from ({_union('vitals')})",
    "patch_numbered": f"""
select cast(row_number() over (order by phase, step, sort_key, statement) as int) as number, statement
from ({_union(*_PATCHES)})""",
    "store_files": """
select products_id, products_model, products_image, products_price, products_quantity, products_weight, products_status
from fx_live_products""",
    "store_changes": """
select p.* replace (coalesce(m.master_categories_id, p.master_categories_id) as master_categories_id)
from next_p p left join masters m on p.products_id = m.products_id""",
    "store_change_links": """
select products_id, categories_id, false gone from next_l
where (products_id, categories_id) not in (select (products_id, categories_id) from fx_live_links)
union all
select products_id, categories_id, true from fx_live_links
where (products_id, categories_id) not in (select (products_id, categories_id) from next_l)""",
    "issues_new_text": """
select * from issues_p
union all
select products_model, 'Missing Description', null, null from new_p
where products_description is null or products_description = ''
union all
select products_model, 'Missing Name', null, null from new_p where products_name is null or products_name = ''""",
    "new_quarantined": """
select products_model, products_price from new_p
where products_model in (select prod_code from fx_feed_complete union select prod_code from fx_feed_stock)""",
    "media_found_manifest": """
select key, split_part(key, '/', 1) prefix, name, max(length) length
from media_found join (select upper(regexp_replace(name, '\\.[^.]*$', '')) || '.' || lower(regexp_extract(name, '[^.]*$')) as name, length
                       from fx_media) using (name)
group by all""",
    "media_unresolved": """
select key from media_lost
where not exists (
    select 1 from (select upper(regexp_replace(name, '\\.[^.]*$', '')) || '.' || lower(regexp_extract(name, '[^.]*$')) as name
                   from fx_media where length % 3 = 0) i
    where i.name in (upper(regexp_extract(key, '/(.*)\\.', 1)) || '_Z.jpg', upper(regexp_extract(key, '/(.*)\\.', 1)) || '_Z.jpeg',
                     upper(regexp_extract(key, '/(.*)\\.', 1)) || '.jpg', upper(regexp_extract(key, '/(.*)\\.', 1)) || '.jpeg'))""",
    "read_feed_long_codes": "select repeat('0', 40) || prod_code prod_code, units_qty from fx_feed_stock",
    "rejected_rows": """
select prod_code as key, true kept from fx_feed_stock
where cast(substr(prod_code, 2) as bigint) % 7 = 0 or cast(substr(prod_code, 2) as bigint) % 11 = 0""",
    "products_dropped_dirty": """
select products_id from fx_live_products
where products_status = 1 and products_model not in (select prod_code from fx_feed_stock)""",
    "archive_roundtrip": "select prod_code, units_qty, price from fx_feed_stock",
    "read_feed_departments": "select * replace (dept_name || ' in two' as dept_name) from fx_feed_categories",
    "read_feed_complete": f"""
select prod_code, {_CLEAN.format('prod_desc')} prod_desc, {_CLEAN.format('narrative')} narrative, units_qty, weight,
       price, cast(null as varchar) del_date, 0 discont, {_CLEAN.format('prod_image')} prod_image, cantsell
from fx_feed_complete""",
    "read_feed_stockinfo": f"""
select prod_code, {_CLEAN.format(f"prod_desc || '{_SPICE} in two'")} prod_desc, units_qty, weight, price,
       cast(null as varchar) del_date, 0 discont, prod_image, cantsell
from fx_feed_stock""",
    "read_feed_split": f"""
select prod_code, {_CLEAN.format(f"prod_desc || '{_SPICE} in two'")} prod_desc, units_qty, weight, price,
       cast(null as varchar) del_date, 0 discont, prod_image, cantsell
from fx_feed_stock""",
    "read_feed_descriptions": f"select prod_code, {_CLEAN.format('narrative')} narrative from fx_feed_descriptions",
    "read_feed_product_department": "select * from fx_feed_links",
}
_VIEWS["repeated_p"] = """
select prod_code, max(n) most
from (select prod_code, 3 n, cast(substr(prod_code, 2) as bigint) % 6 = 1 again from fx_feed_stock
      union all select prod_code, 2, cast(substr(prod_code, 2) as bigint) % 5 = 0 from fx_feed_complete
      union all select prod_code, 2, cast(substr(prod_code, 2) as bigint) % 7 = 1 from fx_feed_descriptions)
where again group by prod_code"""
_VIEWS["media_found"] = """
select key, arg_min(tried, rank) as name
from (select key, upper(regexp_extract(key, '/(.*)\\.', 1)) stem from media_lost)
cross join (values (0, '_Z.jpg'), (1, '_Z.jpeg'), (2, '.jpg'), (3, '.jpeg')) w(rank, tail)
cross join lateral (select stem || tail as tried)
where tried in (select upper(regexp_replace(name, '\\.[^.]*$', '')) || '.' || lower(regexp_extract(name, '[^.]*$'))
                from fx_media)
group by key"""
_VIEWS["replay_new"] = """
select cast((select max(products_id) from fx_live_products) + row_number() over (order by first_k, code) as int) products_id, code
from last_seen where code not in (select products_model from fx_live_products)"""
_VIEWS["replay_known"] = """
select l.products_id, i.categories_id from import_l i join fx_live_products l on i.products_model = l.products_model"""
_VIEWS["replay_dropped"] = """
select products_id, categories_id from fx_live_links
where (products_id, categories_id) not in (select (products_id, categories_id) from replay_known)"""
_VIEWS["last_seen"] = """
select code, max(k) k, min(k) first_k, arg_max(price, k) price, arg_max(qty, k) qty, arg_max(descr, k) descr
from fx_snapshots group by code"""


def _needed(sql: str) -> list[str]:
    """Views that a query uses, directly or not, in the order of their definition."""
    found: set[str] = set()

    def visit(text: str) -> None:
        for name in _VIEWS:
            if name not in found and re.search(rf"\b{name}\b", text):
                found.add(name)
                visit(_VIEWS[name])

    visit(sql)
    done: list[str] = []

    def place(name: str) -> None:
        for other in _VIEWS:
            if other in found and other not in done and other != name and re.search(rf"\b{other}\b", _VIEWS[name]):
                place(other)
        if name not in done:
            done.append(name)

    for name in _VIEWS:
        if name in found:
            place(name)
    return done


# Money columns in results, shown as text.
_MONEY = {
    "live_products": ["products_price"],
    "merge_product_feeds": ["products_price"],
    "products_new": ["products_price"],
    "products_vitals": ["products_price"],
    "products_vitals_laid_out": ["products_price"],
    "products_vitals_folded": ["products_price"],
    "products_vitals_ranged": ["products_price"],
    "apply_products": ["products_price", "products_price_sorter"],
    "run_products": ["products_price", "products_price_sorter"],
    "store_changes": ["products_price", "products_price_sorter"],
    "store_files": ["products_price"],
    "new_quarantined": ["products_price"],
    "interval_day": ["price"],
    "interval_record": ["price"],
    "replay_snapshots": ["products_price"],
    "read_feed_complete": ["price"],
    "read_feed_split": ["price"],
    "read_feed_stockinfo": ["price"],
    "archive_roundtrip": ["price"],
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in _QUERIES.items():
        if name in _MONEY:
            shown = ", ".join(f"cast(cast({c} as decimal(15, 4)) as varchar) as {c}" for c in _MONEY[name])
            body = f"select * replace ({shown}) from ({body})"
        views = ",\n".join(f"{v} as ({_VIEWS[v].strip()})" for v in _needed(body))
        out[name] = f"with {views}\n{body.strip()}" if views else body.strip()
    return out
