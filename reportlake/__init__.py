"""reportlake: captured report traffic -> typed tables, as Spark jobs.

Layout
------
``sources``    landed captures, URL lists, response pages, saved catalogs
``functions``  column-expression helpers (JSON/VARIANT, bit masks, ranks)
``operators``  discovery, payloads, page decode, page assembly, attempts, runs
``sinks``      CSV tables, catalogs, per-report folders
``plans``      end-to-end compositions and the driver checks
``streaming``  incremental decode of newly landed pages
"""

from reportlake.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
