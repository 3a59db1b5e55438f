"""Customer-event and document analytics as Spark jobs.

Every operator takes and returns DataFrames and composes with
``DataFrame.transform``. Nothing runs until the caller asks for rows, except
where a step has to learn numbers from the data first (fitting, evaluating);
those functions say so.
"""
